"""Terms, text, mapping, parts, shapes, rules, lineage and streaming on small hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from lattica.functions import terms, text
from lattica.operators import bgp, lineage, rules, shacl
from lattica.operators.mapping import dropped, losses, map_rows, rejected_types
from lattica.operators.quads import QUAD, distinct_quads, in_scan_order, part_of, part_stats, with_ordinal
from lattica.plans import scope, shapes, sparql, templates, turtle
from lattica.plans import vocabulary as v
from lattica.plans.templates import builtin
from lattica.sources import fingerprint, nquads, registry, tsv

T, P = v.ENTITY + "title/", v.ENTITY + "person/"


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in columns))


def mapped(spark, name, *rows, strict=False, separators=None):
    m = builtin(name)
    columns = [c for f, c in registry.COLUMNS.items() if f.replace(".tsv.gz", "").replace(".", "-") == name][0]
    if separators is not None:
        from dataclasses import replace

        m = replace(m, fields={k: replace(f, separators=separators) if f.kind == "concept" else f for k, f in m.fields.items()})
    return map_rows(frame(spark, columns, *rows).withColumn("part_index", F.lit(0)), m, "http://example.org/g", "part_index", strict=strict)


def found(df):
    return sorted((r["s"].rsplit("/", 1)[-1], r["p"].rsplit("#", 1)[-1], r["o"], (r["o_dt"] or "iri").rsplit("#", 1)[-1]) for r in df.collect())


def test_terms(spark):
    df = frame(spark, ["c"], ("tt1",), (None,), (" Film-Noir ",), ("make_up department",))
    rows = df.select(terms.title_iri(F.col("c")).alias("t"), terms.slug(F.col("c")).alias("s"), terms.slug(F.col("c"), " ").alias("k")).collect()
    assert rows[0]["t"] == T + "tt1" and rows[1]["t"] is None
    assert [r["s"] for r in rows[2:]] == ["film-noir", "make-up-department"] and rows[3]["k"] == "make_up-department"
    names = frame(spark, ["c"], ("a.tsv.gz",), ("a.gz",), ("a.tsv",), ("a.gz.tsv",)).select(terms.tsv_stem(F.col("c")).alias("x")).collect()
    assert [r["x"] for r in names] == ["a", "a", "a", "a.gz"]
    slugs = frame(spark, ["c"], ("--é/x y--",), ("///",), ("a" * 100,)).select(terms.fragment_slug(F.col("c")).alias("x")).collect()
    assert [r["x"] for r in slugs] == ["é-x-y", "artifact", "a" * 80]
    one = frame(spark, ["c"], ("movie",), ("podcast",), (None,)).select(terms.class_iri(F.col("c"), v.TITLE_CLASSES).alias("x")).collect()
    assert [r["x"] for r in one] == [v.IMDB + "Movie", None, None]


def test_lists_flags_and_numbers(spark):
    df = frame(spark, ["c"], (" , ,Drama",), ("a, b ,a",), ("\\N",), (None,), ("  ",))
    assert [r["x"] for r in df.select(text.split_clean(F.col("c")).alias("x")).collect()] == [["Drama"], ["a", "b", "a"], [], [], []]
    n = frame(spark, ["c"], ("8.4",), ("10000000",), ("0.0001",), ("x",), ("12",))
    assert [r["x"] for r in n.select(text.float_text(F.col("c")).alias("x")).collect()] == ["8.4", "10000000.0", "0.0001", None, "12.0"]
    assert [r["x"] for r in n.select(text.integer_text(F.col("c")).alias("x")).collect()][-1] == "12"
    years = frame(spark, ["c"], ("0012",), ("12",), ("abc",), ("2000",)).select(text.well_typed(F.col("c"), v.XSD + "gYear").alias("x")).collect()
    assert [r["x"] for r in years] == [True, False, False, True]


def test_nquads_round_trip(spark):
    rng = random.Random(2)
    alphabet = ['"', "\\", "\n", "\r", "\t", "n", "t", "é", "東", "<", ">", " ", ".", "^", "@", "x"]
    rows = [("http://x/s", "http://x/p", "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))), "literal", v.XSD + "string", "http://x/g") for _ in range(300)]
    rows += [("http://x/s", "http://x/p", "http://x/o", "iri", None, "http://x/g"), ("http://x/s", "http://x/p", '"\\' * 40000, "literal", v.XSD + "string", "http://x/g")]
    quads = spark.createDataFrame(rows, QUAD)
    back = nquads.parse(nquads.render(quads), "line")
    assert sorted(map(str, back.drop("ok").collect())) == sorted(map(str, quads.collect())) and back.where("not ok").count() == 0
    lines = frame(spark, ["value"], ("",), ("# note",), ("nonsense",), ('<a> <b> "c" .',), ('<a> <b> "c"@en <g> .',), ("<a> <b> <c> <g> . x",))
    assert [(r["ok"], r["o"]) for r in nquads.parse(lines).collect()] == [(False, None), (True, "c"), (True, "c"), (False, None)]


def test_nquads_of_others(spark):
    """Languages, numbered characters, blank nodes, the default graph; what the standard forbids can't be read."""
    good = {
        r'<http://a> <http://p> "caf\u00e9 \U0001F600 \uD83D\uDE00 \\u00e9 \t\b\f\'\"" <http://g> .': ("http://a", 'café 😀 😀 \\u00e9 \t\b\f\'"', "literal", v.XSD + "string", "http://g"),
        '<http://a> <http://p> "x"@EN-gb .': ("http://a", "x", "literal", "@en-gb", None),
        "_:b1 <http://p> _:c.d _:g . # note": ("_:b1", "_:c.d", "blank", None, "_:g"),
        r"<http://a\u00e9><http://p><http://\u00e9x>.": ("http://aé", "http://éx", "iri", None, None),
        '<http://a> <http://p> "1"^^<http://dt> <http://g> .\r\n': ("http://a", "1", "literal", "http://dt", "http://g"),
        '<http://a> <http://p> "" .': ("http://a", "", "literal", v.XSD + "string", None),
    }
    bad = [r'<http://a> <http://p> "\uD83D" .', r'<http://a> <http://p> "\x" .', r'<http://a> <http://p> "\U00110000" .', '<http://a> <http://p> "a\nb" .', '"l" <http://p> <http://o> .', "<http://a> _:p <http://o> .", r"<http://a\x> <http://p> <http://o> .", "\n\n\nx" + "\n" * 6]
    lines = frame(spark, ["value"], *[(x,) for x in [*good, *bad, "", "# c", " \t", None]])
    got = nquads.parse(lines).collect()
    assert sorted(map(str, ((r["s"], r["o"], r["o_kind"], r["o_dt"], r["g"]) for r in got if r["ok"]))) == sorted(map(str, good.values()))
    wrong = [r for r in got if not r["ok"]]
    assert len(wrong) == len(bad) and all(x is None for r in wrong for x in r[:6])
    kept = nquads.parse(lines).where("ok")
    again = nquads.parse(nquads.render(kept), "line")
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


def test_blank_nodes_of_two_files(spark, tmp_path):
    for name in ("a.nq", "b.nq"):
        (tmp_path / name).write_text("_:x <http://p> _:y .\n_:y <http://p> <http://o> .\n", encoding="utf-8")
    apart = nquads.read(spark, str(tmp_path))
    assert apart.select("s").distinct().count() == 4 and apart.where("o_kind = 'blank'").select("o").join(apart.select(F.col("s").alias("o")), "o").count() == 2
    assert nquads.read(spark, str(tmp_path), shared_labels=True).select("s").distinct().count() == 2


def test_store(spark, tmp_path):
    """A frequent predicate is spread, and what was written is read."""
    rows = spark.range(4000).selectExpr("concat('u:', id) s", "if(id % 10 = 0, 'u:q', 'u:p') p", "'o' o", "'iri' o_kind", "cast(null as string) o_dt", "'g' g", "'asserted' zone", "'a' tsv_stem")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table is else one file
    try:
        nquads.write_table(rows, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(str(tmp_path))
    assert back.count() == 4000 and back.exceptAll(rows.select(*back.columns)).count() == 0
    assert back.where("p = 'u:p'").select(F.input_file_name()).distinct().count() > 1


def test_blank_nodes_in_shapes(spark):
    iri = lambda s, p, o, kind="iri", part=0: (s, p, o, kind, None, "g", part)
    year = lambda s, y, part=0: (s, "u:year", y, "literal", v.XSD + "gYear", "g", part)
    rows = [iri("_:e", v.RDF + "type", "u:E"), iri("_:e", "u:of", "_:t", "blank"), year("_:e", "1990"), year("_:t", "2000"), iri("u:f", v.RDF + "type", "u:E"), iri("u:f", "u:of", "_:t", "blank"), year("u:f", "2010")]
    quads = spark.createDataFrame(rows, QUAD + ", part_index int")
    shape = shapes.Shape("u:S", ("class", "u:E"), (shapes.PropertyShape("u:of", node_kind="iri"),), (shapes.QueryConstraint(sparql.parse("SELECT $this WHERE { $this <u:of> ?t ; <u:year> ?a . ?t <u:year> ?b . FILTER (?a < ?b) }")),))
    for parts in (("part_index",), ()):
        found = {(r["focus"], r["component"]) for r in shacl.Validator(quads, [], parts).results([shape]).collect()}
        assert found == {("_:e", "nodeKind"), ("u:f", "nodeKind"), ("_:e", "sparql")}


def test_types_from_domains_and_ranges(spark):
    ontology = [("u:p", v.RDFS + "domain", "u:D"), ("u:p", v.RDFS + "domain", "u:D2"), ("u:p", v.RDFS + "range", "u:R"), ("u:q", v.RDFS + "range", "u:N")]
    rows = [("a", "u:p", "b", "iri", None, "g"), ("a", "u:p", "b", "iri", None, "g2"), ("a", "u:p", "b", "literal", "t", "g"), ("a", "u:q", "1", "literal", "t", "g"), ("a", "u:z", "c", "iri", None, "g"), (None, "u:z", None, None, None, None)]
    quads = spark.createDataFrame(rows, QUAD)
    assert {(r["s"], r["o"]) for r in rules.typed_by_ends(quads, ontology, "i").collect()} == {("a", "u:D"), ("a", "u:D2"), ("b", "u:R")}
    assert rules.typed_by_ends(quads, [], "i").count() == 0 and rules.typed_by_ends(quads.where("false"), ontology, "i").count() == 0


def test_ratings_and_rule(spark):
    quads = mapped(spark, "title-ratings", ("tt1", "8.4", "1500"), ("tt2", "8.4", "999"), ("tt3", "7.9", "5000"), ("tt4", "8.0", "1000"))
    assert quads.count() == 8
    typed = [(T + x, v.RDF + "type", v.IMDB + c, "iri", None, "http://x/g") for x, c in (("tt1", "Title"), ("tt2", "Title"), ("tt3", "Title"), ("tt4", "Movie"))]
    typed += [(T + "tt9", v.RDF + "type", v.CORE + "Person", "iri", None, "http://x/g"), (T + "tt9", v.IMDB + "averageRating", "9.0", "literal", v.XSD + "float", "http://x/g"), (T + "tt9", v.IMDB + "numVotes", "5000", "literal", v.XSD + "integer", "http://x/g")]
    typed = spark.createDataFrame(typed, QUAD)
    of = lambda q: rules.apply_rules(q, shapes.read(shapes.RULES), "http://example.org/inferred", v.ontology_triples())
    assert of(quads).count() == 0  # of no class, and so no focus of the rule
    derived = of(quads.select(*typed.columns).unionByName(typed))
    assert found(derived) == [("tt1", "type", v.IMDB + "ClassicTitle", "iri"), ("tt4", "type", v.IMDB + "ClassicTitle", "iri")]


def test_missing_rating(spark):
    rows = ("tt1", None, "5"), ("tt2", "\\N", "6")
    assert mapped(spark, "title-ratings", *rows).count() == 2
    counts = dropped(frame(spark, registry.COLUMNS["title.ratings.tsv.gz"], *rows), builtin("title-ratings"))
    assert {r["field"]: r["dropped_null"] for r in counts.collect()} == {"averageRating": 2, "numVotes": 0}
    assert losses(frame(spark, registry.COLUMNS["title.ratings.tsv.gz"], *rows), builtin("title-ratings"))["dropped_null"] == {"averageRating": 2, "numVotes": 0}
    with pytest.raises(Exception, match="isn't set"):
        mapped(spark, "title-ratings", *rows, strict=True).collect()


def test_episodes_and_class_scope(spark):
    quads = mapped(spark, "title-episode", ("tt10", "tt11", "1", "2"), ("tt12", "tt11", None, "3"), ("tt13", "tt11", None, None))
    assert quads.count() == 6
    own = shapes.BINDINGS.shapes("title-episode")
    results = shacl.Validator(quads, v.ontology_triples()).results(own)
    got = {(r["focus"].rsplit("/", 1)[-1], r["component"]) for r in results.collect()}
    assert got == {("tt12", "minCount"), ("tt10", "class"), ("tt12", "class")}
    titles = mapped(spark, "title-basics", ("tt11", "tvSeries", "a", "a", "0", None, None, None, None))
    results = shacl.Validator(quads, v.ontology_triples(), context=titles).results(own)
    assert {(r["focus"].rsplit("/", 1)[-1], r["component"]) for r in results.collect()} == {("tt12", "minCount")}


def test_titles(spark):
    quads = mapped(spark, "title-basics", ("t1", "movie", "A", "A", "1", "1999", None, "90", "Film-Noir,Sci-Fi"), ("t2", "movie", "B", "B", "0", None, "1990", None, " , ,Drama"), ("t3", "movie", "C", "C", "7", None, None, None, None))
    rows = found(quads)
    assert [r[2] for r in rows if r[1] == "isAdult"] == ["true", "false", "false"]
    assert [r[2].rsplit("#", 1)[-1] for r in rows if r[1] == "hasGenre"] == ["film-noir", "sci-fi", "drama"]
    results = shacl.Validator(quads, v.ontology_triples()).results(shapes.BINDINGS.shapes("title-basics")).collect()
    assert [(r["focus"], r["component"]) for r in results] == [(T + "t2", "sparql")]


def test_unknown_type_and_genre(spark):
    row = ("t1", "podcastSeries", "A", "A", "0", None, None, None, "Nonsense")
    with pytest.raises(Exception, match="unknown type"):
        mapped(spark, "title-basics", row, strict=True).collect()
    assert rejected_types(frame(spark, registry.COLUMNS["title.basics.tsv.gz"], row), builtin("title-basics")).count() == 1
    assert losses(frame(spark, registry.COLUMNS["title.basics.tsv.gz"], row), builtin("title-basics"))["unknown_type"] == {"titleType": 1}
    results = shacl.Validator(mapped(spark, "title-basics", row), v.ontology_triples()).results(shapes.BINDINGS.shapes("title-basics"))
    assert sorted((r["component"], r["severity"]) for r in results.collect()) == [("class", "Violation"), ("class", "Warning"), ("sparql", "Violation")]


def test_people(spark):
    row = ("n1", "Ann", "1950", "1940", "actor,animation_department", "tt1,tt2")
    for separators, bad in ((None, {"class", "sparql"}), (" ", set())):
        quads = mapped(spark, "name-basics", row, separators=separators)
        assert quads.count() == 8
        results = shacl.Validator(quads, v.ontology_triples()).results(shapes.BINDINGS.shapes("name-basics")).collect()
        assert {r["component"] for r in results if r["focus"].startswith(v.VOCAB)} == bad
        assert [r["component"] for r in results if r["focus"] == P + "n1"] == ["sparql"]


def test_parts_do_not_see_each_other(spark):
    """A death in one part and a birth in the other are no contradiction until the parts are one."""
    g = "http://example.org/g"
    rows = [(P + "x", v.RDF + "type", v.CORE + "Person", "iri", None, g, 0), (P + "x", v.CORE + "name", "X", "literal", v.XSD + "string", g, 0), (P + "x", v.CORE + "birthYear", "1950", "literal", v.XSD + "gYear", g, 0), (P + "x", v.CORE + "deathYear", "1900", "literal", v.XSD + "gYear", g, 1)]
    quads = spark.createDataFrame(rows, QUAD + ", part_index int")
    own = [s for s in shapes.read(shapes.DATA_QUALITY) if s.target[1] == v.CORE + "Person"]
    assert shacl.Validator(quads, []).results(own).count() == 0
    assert shacl.Validator(quads, [], parts=()).results(own).count() == 1


def test_bags_and_sets(spark):
    rows = ("tt1", "8.0", "5"), ("tt1", "8.0", "5")
    quads = mapped(spark, "title-ratings", *rows)
    assert quads.count() == 4 and distinct_quads(quads).count() == 2
    shape = shapes.Shape("x", ("subjects", v.IMDB + "numVotes"), (shapes.PropertyShape(v.IMDB + "numVotes", 2),))
    assert shacl.Validator(quads, []).results([shape]).count() == 1  # one value, however often it is said


def test_parts_and_gate(spark):
    rows = spark.range(2500).select(F.col("id").cast("string").alias("tconst"), F.when(F.col("id") == 1200, "12").otherwise("2000").alias("startYear"))
    placed = with_ordinal(rows.repartition(5), F.col("tconst").cast("long")).withColumn("part_index", part_of(F.col("row_ord"), 1000))
    assert placed.where("row_ord <> cast(tconst as long)").count() == 0
    quads = placed.select(F.concat(F.lit(T), "tconst").alias("s"), F.lit(v.IMDB + "startYear").alias("p"), F.col("startYear").alias("o"), F.lit("literal").alias("o_kind"), F.lit(v.XSD + "gYear").alias("o_dt"), F.lit("g").alias("g"), "part_index")
    stats = {r["part_index"]: (r["rows"], r["triples"]) for r in part_stats(placed, quads).collect()}
    assert stats == {0: (1000, 1000), 1: (1000, 1000), 2: (500, 500)}
    shape = shapes.Shape("x", ("subjects", v.IMDB + "startYear"), (shapes.PropertyShape(v.IMDB + "startYear", datatype=v.XSD + "gYear"),))
    gated = shacl.gate(placed, shacl.Validator(quads, []).results([shape]))
    assert {r["part_index"]: r["zone"] for r in gated.collect()} == {0: "asserted", 1: "quarantine", 2: "asserted"}
    transforms = spark.createDataFrame([("a", True), ("b", False)], "transform string, has_shapes boolean")
    got = {r["transform"]: r["status"] for r in shacl.status(gated.withColumn("transform", F.lit("a")), transforms).collect()}
    assert got == {"a": "failed-partial", "b": "skipped-no-parts"}


def test_templates():
    t = templates.parse(templates.TEXTS["title-basics"])
    assert [len(x.triples) for x in t] == [8, 1] and t[0].parameters[1].optional and t[0].parameters[0].type == "ottr:IRI"
    assert templates.catalog(t)["template_count"] == 2
    with pytest.raises(ValueError, match="aren't parameters"):
        templates.parse("@prefix a: <x#>.\na:T [ ?s ] :: { ottr:Triple(?s, a:p, ?o) } .")
    with pytest.raises(KeyError):
        builtin("nothing")


def test_scope_and_bindings(tmp_path):
    s = scope.builtin()
    assert len(scope.take(s)) == 5 and [x.name for x in s.values() if not x.active] == ["title-crew"]
    assert [x.name for x in scope.take(s, ["title-akas", "title-crew", "?"])] == ["title-akas"]
    config = tmp_path / "steps.toml"
    config.write_text('part_rows = 7\n[files."a.tsv.gz"]\nstep = "a"\n[files."b.tsv.gz"]\nstep = "b"\nversion = "b@v2"\nactive = false\n')
    assert scope.load(config) == {"a": scope.Step("a", "a.tsv.gz", "materialize-a@v1", 7), "b": scope.Step("b", "b.tsv.gz", "b@v2", 7, False)}
    assert scope.parse_only(" a, ,b") == ["a", "b"] and scope.parse_only("") is None
    extra = 'imdb:X a sh:NodeShape ; sh:targetClass imdb:Title ; pipeline:appliesToTransform "title-akas", "title-basics" .'
    b = shapes.Bindings({"title-basics": ("data-quality",)}, {"data-quality": shapes.DATA_QUALITY, "extra": extra})
    assert b.names("title-akas") == ["extra"] and b.names("title-basics") == ["data-quality", "extra"]
    with pytest.raises(FileNotFoundError):
        registry.discover(registry.SOURCES["imdb"], tmp_path)


def test_turtle_round_trip():
    quads = turtle.parse('PREFIX x: <http://x/>\n@base <http://example.org/> .\nGRAPH <graph/a> { x:s a x:C ; x:p "q\\"\\n", 3, "z"^^xsd:gYear, <rel> . } x:t x:p ( x:a x:b ) .')
    assert ("iri", "http://example.org/rel") in [q[2] for q in quads]
    assert set(turtle.parse(turtle.trig([q for q in quads if q[3]]))) == {q for q in quads if q[3]}
    with pytest.raises(ValueError):
        turtle.parse("x:s ~ x:o .")


def test_patterns(spark):
    q = lambda s, p, o, k="iri", d=None: ("http://x/" + s, "http://x/" + p, "http://x/" + o if k == "iri" else o, k, d, "g")
    quads = spark.createDataFrame([q("a", "knows", "b"), q("b", "knows", "c"), q("a", "age", "30", "literal", v.XSD + "integer"), q("b", "age", "old", "literal", v.XSD + "string"), q("c", "age", "5", "literal", v.XSD + "integer"), q("b", "likes", "b")], QUAD)
    run = lambda text_: sorted(r[0].rsplit("/", 1)[-1] for r in bgp.select(quads, sparql.parse("PREFIX x: <http://x/> " + text_)).collect())
    assert run("SELECT ?y WHERE { ?x x:knows ?y . ?y x:knows ?z }") == ["b"]
    assert run("SELECT ?x WHERE { ?x x:age ?a . FILTER (?a > 10) }") == ["a"]
    assert run("SELECT ?x WHERE { ?x x:age ?a . FILTER (!(?a > 10) && ?a < 6 || ?a = 30) }") == ["a", "c"]
    assert run("SELECT ?x WHERE { ?x x:age ?a . FILTER NOT EXISTS { ?x x:knows ?y . } }") == ["c"]
    assert run('SELECT ?x WHERE { ?x x:age "old" . }') == ["b"]
    assert run("SELECT ?x WHERE { ?x x:likes ?x . }") == ["b"]
    with pytest.raises(ValueError):
        run("SELECT ?x WHERE { ?x ?p ?o }")


def test_rules_and_closures(spark):
    link = lambda s, o, p="k": (s, p, o, "iri", None, "g")
    quads = spark.createDataFrame([link("a", "t"), link("b", "t"), link("c", "u"), link("a", "t"), link("t", "g1", "h"), link("u", "g2", "h")], QUAD)
    pairs = {(r["s"], r["o"]) for r in rules.symmetric_pairs(quads, "co", "k", "i").collect()}
    assert pairs == {("a", "b"), ("b", "a")}
    assert {(r["s"], r["o"]) for r in rules.chain(quads, "w", "k", "h", "i").collect()} == {("a", "g1"), ("b", "g1"), ("c", "g2")}
    assert {(r["s"], r["o"]) for r in rules.inverse(quads, "kk", "k", "i").collect()} == {("t", "a"), ("t", "b"), ("u", "c")}
    assert [r["s"] for r in rules.at_least(quads, "k", 2, "type", "C", "i").collect()] == ["t"]
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x")]
    closed = {(r["sub"], r["sup"]) for r in rules.closure(spark.createDataFrame(edges, "sub string, sup string")).collect()}
    assert closed == set(rules.close_pairs(edges)) and ("a", "d") in closed and ("x", "x") in closed
    assert set(rules.close_pairs(sorted(closed))) == closed
    years = [sub for sub, sup in rules.close_pairs(v.subproperty_edges()) if sup == v.CORE + "year"]
    assert v.CORE + "birthYear" in years and v.IMDB + "startYear" in years


def test_lineage(spark):
    steps = spark.sql("select 's' slug, 'http://example.org/activities/1' activity, 'http://example.org/agents/1' agent, 'http://example.org/data/in' input, 'http://example.org/data/out' output, 'm@v1' transform_spec, timestamp'2024-01-01' started_at, timestamp'2024-01-02' ended_at, 5L record_count, cast(null as string) input_type, cast(null as string) output_type")
    quads = lineage.derivations(steps, "http://example.org/graph/p")
    assert quads.count() == 16
    once = lineage.consolidate("http://example.org/graph/p", quads, quads)
    assert once.count() == 16 and lineage.consolidate("http://example.org/graph/p", once).count() == 16
    body = lineage.to_trig(once)
    assert "<data/out> a prov:Entity" in body and 'pipeline:recordCount "5"^^xsd:integer' in body
    assert len(set(turtle.parse(body))) == 16
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "start string, parent string")
    assert {(r["start"], r["ancestor"]): r["depth"] for r in lineage.trace(edges).collect()} == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 1, ("c", "d"): 1, ("a", "d"): 2, ("b", "d"): 2}


def test_fingerprints(spark, tmp_path):
    for name, body in (("b", b"2"), ("a", b"1")):
        (tmp_path / name).write_bytes(body)
    own = {p.name: fingerprint.file_sha256(p) for p in tmp_path.iterdir()}
    digest, batch = fingerprint.combined(own)
    row = fingerprint.combine(fingerprint.hashes(spark, str(tmp_path))).first()
    assert (row["digest"], row["batch_id"]) == (digest, batch) and len(batch) == 16


def test_file_order(spark, tmp_path):
    import gzip

    (tmp_path / "x.tsv.gz").write_bytes(gzip.compress(b"a\tb\n" + b"".join(b'%d\t"%d\n' % (i, i) for i in range(300))))
    rows = in_scan_order(tsv.read(spark, str(tmp_path / "x.tsv.gz"), ("a", "b")))
    assert rows.where("row_ord <> cast(a as long) or b <> concat('\"', a)").count() == 0 and rows.count() == 300


def test_order_of_a_split_file(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("a\n" + "".join(f"{i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = tsv.read(spark, str(tmp_path / "x.tsv"), ("a",))
        assert rows.rdd.getNumPartitions() > 3
        assert in_scan_order(rows).where("row_ord <> cast(a as long)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_plans(spark, sf):
    """One scan with only the columns in use, no join or shuffle to map; a schema check prunes by predicate."""
    from lattica.retail import Tables

    plan = Tables(spark, sf).quads("child")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "l_extendedprice" not in plan and "Python" not in plan


def test_streaming_agrees_with_batch(spark, tmp_path):
    from lattica.streaming import landing

    columns = registry.COLUMNS["title.ratings.tsv.gz"]
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.tsv").write_text("\t".join(columns) + "\n" + "".join(f"tt{k}{i}\t8.{i}\t{i}\n" for i in range(5)))
    args = (builtin("title-ratings"), "http://example.org/g")
    rows = landing.read_stream(spark, str(tmp_path / "in"), columns)
    landing.land(rows, *args, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    landing.land(rows, *args, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()  # nothing new
    batch = map_rows(tsv.read(spark, str(tmp_path / "in"), columns), *args)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).drop("batch").collect())) == sorted(map(str, batch.collect()))


def test_floats_of_any_size(spark):
    values = ["1e30", "-1e30", "1e-12", "8.4", "1e7", "12345678.25", "-0.00012", "123456789012345680", "0", "1.5e300", "4.9e-324", "NaN", "Infinity", "-Infinity", "x", None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string").orderBy("i").select(text.float_text(F.col("x"))).collect()]
    for x, y in zip(values, got, strict=True):
        if x in ("x", None):
            assert y is None
        elif x[-1] in "Ny":
            assert y == {"NaN": "NaN", "Infinity": "INF", "-Infinity": "-INF"}[x]
        else:
            assert float(y) == float(x) and "E" not in y and "." in y, (x, y)
