"""One query for each operator over the retail tables, each beside the SQL that must agree with it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import retail as r
from .functions import terms, text
from .operators import bgp, lineage, rules, shacl
from .operators.mapping import map_rows
from .operators.quads import distinct_quads, part_of, part_stats, totals, union_graphs, with_ordinal, with_predicate
from .plans import scope, shapes, sparql
from .plans.shapes import PropertyShape, QueryConstraint, Shape
from .plans.vocabulary import PIPELINE, PROV, RDF, RDFS, SH, SKOS, XSD
from .retail import NS, VOCAB, N, Tables
from .sources import fingerprint, nquads, tsv
from .sources.registry import DIALECT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CR = 1000


def query(sql: str):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        ORACLES[f.__name__] = sql
        return f

    return add


def _shared_dir(t: Tables) -> str:
    """Where a query may write: the cluster's shared folder, or this machine's own in tests."""
    import tempfile
    import uuid

    base = t.spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not t.spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lattica-")
    return f"{base.rstrip('/')}/lattica-io/{uuid.uuid4().hex}"


_ESC = r"""replace(replace(replace(replace(replace({}, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t')"""
_SLUG = "replace(replace(lower(trim({})), '_', '-'), ' ', '-')"
_STATUS = "case o_orderstatus when 'O' then 'OpenOrder' when 'F' then 'FilledOrder' when 'P' then 'PartialOrder' end"

# ---- sources


@query("select p_partkey::varchar as id, p_name as name, case when p_partkey % 7 = 0 then null else p_brand end as brand, '\"' || p_type as type from part")
def tsv_scan(t: Tables) -> DataFrame:
    """Written and read in the source dialect: null marks and lone quotes survive."""
    rows = t.part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("brand"), F.concat(F.lit('"'), "p_type").alias("type"))
    path = _shared_dir(t)
    rows.write.options(**{k: v for k, v in DIALECT.items() if k != "mode"}, compression="gzip").csv(path)
    return tsv.read(t.spark, path, ("id", "name", "brand", "type"))


@query(" union all ".join(f"select '{n}' as file, count(*)::bigint as row_count, {c}::bigint as column_count from {n}" for n, c in (("orders", 6), ("lineitem", 11), ("customer", 5))))
def profile_table(t: Tables) -> DataFrame:
    out = None
    for n in ("orders", "lineitem", "customer"):
        p = tsv.profile(getattr(t, n), n, "", 0).select("file", "row_count", "column_count")
        out = p if out is None else out.unionByName(p)
    return out


@query("select c_custkey, sha256(c_custkey::varchar || '|' || c_name || '|' || c_nationkey::varchar || '|' || c_mktsegment) as digest from customer")
def row_digest(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.sha2(F.concat_ws("|", "c_custkey", "c_name", "c_nationkey", "c_mktsegment"), 256).alias("digest"))


@query("select digest, substr(digest, 1, 16) as batch_id from (select sha256(string_agg(r_name || ':' || sha256(r_regionkey::varchar || '|' || r_name), '|' order by r_name)) as digest from region)")
def batch_fingerprint(t: Tables) -> DataFrame:
    return fingerprint.combine(t.region.select(F.col("r_name").alias("name"), F.sha2(F.concat_ws("|", "r_regionkey", "r_name"), 256).alias("hash")))


_NATION = f"'{N}nation/' || n_nationkey"
_FOREIGN = "select null as s, null as p, null as o, null as o_kind, null as o_dt, null as g, false as ok from nation"


@query(
    f"select '{N}doc/' || doc_id as s, '{NS}alias' as p, text as o, 'literal' as o_kind, '{XSD}string' as o_dt, '{r.GRAPH}alias' as g, true as ok from documents where text is not null and trim(text) not in ('', '\\N') union all "
    f"select {_NATION}, '{NS}label', chr(233) || chr(128512) || chr(9) || '\\u00e9' || n_name, 'literal', '@en-gb', null, true from nation union all "
    f"select '_:n' || n_nationkey, '{NS}near', '_:r' || n_regionkey, 'blank', null, '{r.GRAPH}alias', true from nation union all {_FOREIGN} union all {_FOREIGN}"
)
def nquad_parse(t: Tables) -> DataFrame:
    """The engine's own lines, and such as others write: languages, numbered characters, blank nodes, no graph; half a surrogate pair and a literal subject can't be read."""
    name, key = F.col("n_name"), F.col("n_nationkey")
    foreign = [
        F.concat(F.lit(f"<{N}nation/"), key, F.lit(f'> <{NS}label> "\\u00e9\\uD83D\\uDE00\\t\\\\u00e9'), name, F.lit('"@en-GB . # said')),
        F.concat(F.lit("_:n"), key, F.lit(f" <{NS}near> _:r"), F.col("n_regionkey"), F.lit(f" <{r.GRAPH}alias> .")),
        F.concat(F.lit(f'<{N}x> <{NS}label> "\\uD83D'), name, F.lit('" .')),
        F.concat(F.lit('"'), name, F.lit(f'" <{NS}label> <{N}x> .')),
    ]
    return nquads.parse(nquads.render(t.quads("alias")).unionByName(t.nation.select(F.explode(F.array(*foreign)).alias("line"))), "line")


_ALL = "('name-basics', 'name.basics.tsv.gz'), ('title-akas', 'title.akas.tsv.gz'), ('title-basics', 'title.basics.tsv.gz'), ('title-episode', 'title.episode.tsv.gz'), ('title-ratings', 'title.ratings.tsv.gz')"


@query(f"select * from (values {_ALL}) x(id, tsv) where id in ('title-ratings', 'title-basics', 'nothing')")
def scope_filter(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x.name, x.file) for x in scope.take(scope.builtin(), ["title-ratings", "title-basics", "title-crew", "nothing"])], "id string, tsv string")


# ---- projections


@query(f"select c_custkey, '{N}customer/' || nullif(c_custkey % 7, 0) as iri from customer")
def entity_iri(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", terms.entity_iri(N + "customer/", F.nullif(F.col("c_custkey") % 7, F.lit(0))).alias("iri"))


@query(f"select o_orderkey, '{NS}' || {_STATUS} as class from orders")
def class_lookup(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", terms.class_iri(F.col("o_orderstatus"), dict(r.STATUS), NS).alias("class"))


@query(f"select label, '{VOCAB}' || {_SLUG.format('label')} as concept, count(*)::bigint as n from (select o_orderpriority as label from orders union all select ' ' || r_name || '_x ' from region) group by 1, 2")
def vocab_slug(t: Tables) -> DataFrame:
    labels = t.orders.select(F.col("o_orderpriority").alias("label")).unionByName(t.region.select(F.concat(F.lit(" "), "r_name", F.lit("_x ")).alias("label")))
    return labels.select("label", terms.concept_iri(F.col("label"), VOCAB).alias("concept")).groupBy("label", "concept").agg(F.count("*").alias("n"))


@query("select p_partkey, len(items)::bigint as n, array_to_string(items, '|') as items from (select p_partkey, list_filter(list_transform(string_split(case when p_partkey % 9 = 0 then ' , ,x' else replace(p_name, ' ', ' , ') end, ','), lambda x: trim(x)), lambda x: x <> '') as items from part)")
def split_clean(t: Tables) -> DataFrame:
    items = text.split_clean(F.when(F.col("p_partkey") % 9 == 0, F.lit(" , ,x")).otherwise(F.replace("p_name", F.lit(" "), F.lit(" , "))))
    return t.part.select("p_partkey", F.size(items).cast("long").alias("n"), F.array_join(items, "|").alias("items"))


@query("select c_custkey from customer where c_custkey % 5 not in (0, 1, 2)")
def is_set_filter(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 5
    return t.customer.withColumn("v", F.when(k == 0, F.lit("\\N")).when(k == 1, F.lit("  ")).when(k == 2, F.lit(None)).otherwise(F.col("c_mktsegment"))).where(text.is_set(F.col("v"))).select("c_custkey")


@query("select p_partkey, case when p_size = 1 then 'true' else 'false' end as flag from part")
def bool_flag(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.flag(F.col("p_size")).alias("flag"))


@query(f"select doc_id, length({_ESC.format('text')})::bigint as length, sha256({_ESC.format('text')}) as digest from documents")
def literal_escape(t: Tables) -> DataFrame:
    made = t.documents.select("doc_id", text.escape(F.col("text")).alias("e"))
    return made.select("doc_id", F.length("e").cast("long").alias("length"), F.sha2("e", 256).alias("digest"))


@query(f"select sha256('<{N}doc/' || doc_id || '> <{NS}alias> \"' || {_ESC.format('text')} || '\"^^<{XSD}string> <{r.GRAPH}alias> .') as digest, count(*)::bigint as n from documents where text is not null and trim(text) not in ('', '\\N') group by 1")
def nquad_format(t: Tables) -> DataFrame:
    return nquads.render(t.quads("alias")).groupBy(F.sha2("line", 256).alias("digest")).agg(F.count("*").alias("n"))


_FILES = "(select 'a' || n_nationkey || case n_nationkey % 4 when 0 then '.tsv.gz' when 1 then '.tsv' when 2 then '.gz' else '.gz.tsv' end as file from nation)"


def _files(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 4
    return t.nation.select(F.concat(F.lit("a"), "n_nationkey", F.when(k == 0, ".tsv.gz").when(k == 1, ".tsv").when(k == 2, ".gz").otherwise(".gz.tsv")).alias("file"))


_STEM = r"regexp_replace(regexp_replace(file, '\.gz$', ''), '\.tsv$', '')"


@query(f"select file, {_STEM} as stem from {_FILES}")
def tsv_stem(t: Tables) -> DataFrame:
    return _files(t).select("file", terms.tsv_stem(F.col("file")).alias("stem"))


@query(f"select file, 'http://example.org/graph/asserted/imdb/b1/' || {_STEM} as iri from {_FILES}")
def graph_iri(t: Tables) -> DataFrame:
    return _files(t).select("file", terms.graph_iri("asserted", "imdb", "b1", F.col("file")).alias("iri"))


@query(r"select page_id, coalesce(nullif(substr(regexp_replace(regexp_replace(url, '[^\p{L}\p{N}._-]', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''), 'artifact') as slug from pages")
def fragment_slug(t: Tables) -> DataFrame:
    return t.pages.select("page_id", terms.fragment_slug(F.col("url")).alias("slug"))


@query("select n_nationkey, '<data/' || n_name || '> prov:used <graph/x>, <http://example.org/other/' || n_name || '> .' as line from nation")
def iri_compact(t: Tables) -> DataFrame:
    line = F.concat(F.lit("<http://example.org/data/"), "n_name", F.lit("> prov:used <http://example.org/graph/x>, <http://example.org/other/"), "n_name", F.lit("> ."))
    return t.nation.select("n_nationkey", terms.compact(line).alias("line"))


# ---- mappers

_CHILD = "(select *, l_orderkey || '-' || l_linenumber as line_id from lineitem)"


@query(f"select '{N}part/' || p_partkey as s, '{NS}price' as p, p_retailprice::decimal(38,2)::varchar as o, '{XSD}float' as o_dt from part union all select '{N}part/' || p_partkey, '{NS}size', p_size::varchar, '{XSD}integer' from part")
def map_ratings(t: Tables) -> DataFrame:
    return t.quads("ratings").select("s", "p", "o", "o_dt")


@query(f"select '{N}doc/' || doc_id as s, '{NS}alias' as p, sha256(text) as o from documents where text is not null and trim(text) not in ('', '\\N')")
def map_alias(t: Tables) -> DataFrame:
    return t.quads("alias").select("s", "p", F.sha2("o", 256).alias("o"))


@query(
    f"select '{N}lineitem/' || line_id as s, '{NS}partOf' as p, '{N}order/' || l_orderkey as o, 'iri' as o_kind from {_CHILD} union all "
    f"select '{N}lineitem/' || line_id, '{NS}quantity', l_quantity::int::varchar, 'literal' from {_CHILD} where l_linenumber % 3 <> 0 union all "
    f"select '{N}lineitem/' || line_id, '{NS}lineNumber', l_linenumber::varchar, 'literal' from {_CHILD}"
)
def map_child(t: Tables) -> DataFrame:
    return t.quads("child").select("s", "p", "o", "o_kind")


@query(
    f"select s, p, o, o_kind, o_dt from (select '{N}order/' || o_orderkey as s, unnest([{{'p': '{RDF}type', 'o': '{NS}Order', 'o_kind': 'iri', 'o_dt': null}}, {{'p': '{RDF}type', 'o': '{NS}' || {_STATUS}, 'o_kind': 'iri', 'o_dt': null}}, "
    f"{{'p': '{NS}year', 'o': year(o_orderdate)::varchar, 'o_kind': 'literal', 'o_dt': '{XSD}gYear'}}, {{'p': '{NS}totalPrice', 'o': o_totalprice::decimal(38,2)::varchar, 'o_kind': 'literal', 'o_dt': '{XSD}float'}}, "
    f"{{'p': '{NS}priority', 'o': '{VOCAB}' || {_SLUG.format('o_orderpriority')}, 'o_kind': 'iri', 'o_dt': null}}], recursive := true) from orders) where o is not null"
)
def map_wide(t: Tables) -> DataFrame:
    return t.quads("wide").select("s", "p", "o", "o_kind", "o_dt")


@query(f"select '{N}part/' || p_partkey as s, '{NS}word' as p, '{VOCAB}' || lower(w) as o from (select p_partkey, unnest(string_split(p_name, ' ')) as w from part) where w <> ''")
def map_multivalue(t: Tables) -> DataFrame:
    return t.quads("multi").select("s", "p", "o")


@query(f"select '{N}part/' || p_partkey as s, '{NS}madeBy' as p, '{N}brand/' || replace(p_brand, '#', '-') as o from part union all select '{N}part/' || p_partkey, '{NS}ofType', '{N}type/' || w from (select p_partkey, unnest(string_split(p_type, ' ')) as w from part where p_partkey % 5 <> 0) where w <> ''")
def map_crew_ext(t: Tables) -> DataFrame:
    return t.quads("crew").select("s", "p", "o")


# ---- parts and totals

_PARTS = f"(select *, ((row_number() over (order by o_orderkey) - 1) // {CR})::int as part_index from orders)"


def _parts(t: Tables) -> DataFrame:
    return with_ordinal(t.orders, "o_orderkey").withColumn("part_index", part_of(F.col("row_ord"), CR))


@query(f"select o_orderkey, part_index from {_PARTS}")
def chunk_assign(t: Tables) -> DataFrame:
    return _parts(t).select("o_orderkey", "part_index")


def _part_quads(t: Tables) -> tuple[DataFrame, DataFrame]:
    # only some parts have quads: an expensive order in the upper half of the keys' remainders
    rows = _parts(t).withColumn("year", F.when((F.col("part_index") % 3 != 0) & (F.col("o_totalprice") > 200000), F.year("o_orderdate")))
    return rows, map_rows(rows, r.WIDE, r.GRAPH + "wide", "part_index").where(F.col("p") == NS + "year")


@query(f"select part_index, count(*)::bigint as rows, count_if(part_index % 3 <> 0 and o_totalprice > 200000)::bigint as triples from {_PARTS} group by 1")
def chunk_stats(t: Tables) -> DataFrame:
    return part_stats(*_part_quads(t))


@query(f"select count(distinct part_index)::bigint as parts, count(*)::bigint as rows, count_if(part_index % 3 <> 0 and o_totalprice > 200000)::bigint as triples from {_PARTS}")
def materialize_totals(t: Tables) -> DataFrame:
    return totals(part_stats(*_part_quads(t)))


@query("select n_nationkey, n_nationkey % 3 = 0 as skipped from nation")
def skip_decision(t: Tables) -> DataFrame:
    """A step is skipped where its input hash, transform and mapping are those recorded."""
    now = t.nation.select("n_nationkey", F.sha2(F.concat_ws("|", "n_name", F.lit("map@v1")), 256).alias("key"))
    known = t.nation.select(F.col("n_nationkey").alias("k"), F.sha2(F.concat_ws("|", "n_name", F.when(F.col("n_nationkey") % 3 == 0, F.lit("map@v1")).otherwise(F.lit("map@v0"))), 256).alias("known"))
    return now.join(known, F.col("n_nationkey") == F.col("k"), "left").select("n_nationkey", F.coalesce(F.col("key") == F.col("known"), F.lit(False)).alias("skipped"))


@query("select count(*)::bigint as file_count, sum(row_count)::bigint as row_count from (" + ORACLES["profile_table"] + ")")
def manifest_totals(t: Tables) -> DataFrame:
    return profile_table(t).agg(F.count("*").alias("file_count"), F.sum("row_count").alias("row_count"))


# ---- joins and sets


@query(f"select '{N}part/' || p_partkey as this, p_retailprice::decimal(38,2)::varchar as r, p_size::varchar as v from part")
def bgp_star_join(t: Tables) -> DataFrame:
    return bgp.select(t.quads("ratings"), sparql.parse(f"PREFIX r: <{NS}> SELECT $this ?r ?v WHERE {{ $this r:price ?r ; r:size ?v . }}"))


@query(f"select '{N}customer/' || o_custkey as s, c_name as name, count(*)::bigint as n from orders join customer on o_custkey = c_custkey group by 1, 2")
def cross_graph_join(t: Tables) -> DataFrame:
    both = t.quads("customer", "placed")
    names = with_predicate(both, NS + "name").select("s", F.col("o").alias("name"))
    return with_predicate(both, NS + "placed").join(names, "s").groupBy("s", "name").agg(F.count("*").alias("n"))


@query("select (select count(*) from (" + ORACLES["map_child"] + "))::bigint as before, (select count(*) from (select distinct * from (" + ORACLES["map_child"] + ")))::bigint as after")
def dedup_quads(t: Tables) -> DataFrame:
    quads = t.quads("child")
    return distinct_quads(quads).agg(F.count("*").alias("after")).join(F.broadcast(quads.agg(F.count("*").alias("before"))), F.lit(True)).select("before", "after")


@query("select n_name as file from nation where n_nationkey % 4 = 1")
def missing_files(t: Tables) -> DataFrame:
    expected = t.nation.select(F.col("n_name").alias("file"))
    return expected.join(t.nation.where(F.col("n_nationkey") % 4 != 1).select(F.col("n_name").alias("file")), "file", "left_anti")


@query("select * from (values ('name-basics', 'data-quality,vocab-schemes'), ('title-akas', ''), ('title-basics', 'data-quality,vocab-schemes'), ('title-episode', 'data-quality'), ('title-ratings', '')) x(transform, shapes)")
def shape_binding(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(x.name, ",".join(shapes.BINDINGS.names(x.name))) for x in scope.take(scope.builtin())], "transform string, shapes string")


# ---- shapes


def _validator(quads: DataFrame, parts: tuple[str, ...] = ()) -> shacl.Validator:
    return shacl.Validator(quads, r.ONTOLOGY, parts)


def _order_shape(*properties: PropertyShape, **more) -> Shape:
    return Shape(NS + "OrderShape", ("class", NS + "Order"), tuple(properties), **more)


@query(f"select class, count(*)::bigint as focus_count from (select '{NS}' || {_STATUS} as class from orders union all select '{NS}Order' from orders union all select '{NS}Document' from orders) where class is not null group by 1")
def target_class(t: Tables) -> DataFrame:
    v, out = _validator(t.quads("wide")), None
    for c in ("OpenOrder", "FilledOrder", "PartialOrder", "Order", "Document"):
        n = v.focus(Shape("", ("class", NS + c))).groupBy().agg(F.count("*").alias("focus_count")).where("focus_count > 0").select(F.lit(NS + c).alias("class"), "focus_count")
        out = n if out is None else out.unionByName(n)
    return out


@query(f"select distinct '{N}customer/' || o_custkey as focus from orders")
def target_subjects(t: Tables) -> DataFrame:
    return _validator(t.quads("placed")).focus(Shape("", ("subjects", NS + "placed"))).select("focus")


@query(f"select distinct '{VOCAB}' || {_SLUG.format('o_orderpriority')} as focus from orders")
def target_objects(t: Tables) -> DataFrame:
    return _validator(t.quads("wide")).focus(Shape("", ("objects", NS + "priority"))).select("focus")


@query(f"select '{N}order/' || o_orderkey as focus, '{NS}hasLine' as path, 'minCount' as component from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def shacl_min_count(t: Tables) -> DataFrame:
    lines = rules.inverse(t.quads("child"), NS + "hasLine", NS + "partOf", r.GRAPH + "inferred")
    return _validator(union_graphs(t.quads("wide"), lines)).results([_order_shape(PropertyShape(NS + "hasLine", 1))]).select("focus", "path", "component")


@query(f"select '{N}order/' || o_orderkey as focus, (year(o_orderdate) - case when o_orderkey % 2 = 0 then 1500 else 0 end)::varchar as value from orders where o_orderkey % 2 = 0")
def shacl_datatype(t: Tables) -> DataFrame:
    """Years of fewer than four digits are ill-typed."""
    quads = t.quads("wide").withColumn("o", F.when((F.col("p") == NS + "year") & (F.substring_index("s", "/", -1).cast("long") % 2 == 0), (F.col("o").try_cast("int") - 1500).cast("string")).otherwise(F.col("o")))
    return _validator(quads).results([_order_shape(PropertyShape(NS + "year", datatype=XSD + "gYear"))]).select("focus", "value")


@query(f"select '{N}order/' || o_orderkey as focus, '{VOCAB}' || {_SLUG.format('o_orderpriority')} as value from orders where o_orderkey % 3 = 0")
def shacl_node_kind(t: Tables) -> DataFrame:
    quads = t.quads("wide").withColumn("o_kind", F.when((F.col("p") == NS + "priority") & (F.substring_index("s", "/", -1).cast("long") % 3 == 0), F.lit("literal")).otherwise(F.col("o_kind")))
    return _validator(quads).results([_order_shape(PropertyShape(NS + "priority", node_kind="iri"))]).select("focus", "value")


_OUTSIDE = f"select '{N}customer/' || c_custkey as focus, '{VOCAB}' || {_SLUG.format('c_mktsegment')} as value from customer where lower(c_mktsegment) not in {tuple(r.SEGMENTS)}"


@query(_OUTSIDE)
def shacl_class(t: Tables) -> DataFrame:
    shape = Shape(NS + "CustomerShape", ("class", NS + "Customer"), (PropertyShape(NS + "segment", node_kind="iri", class_=SKOS + "Concept"),))
    return _validator(t.quads("customer")).results([shape]).select("focus", "value")


def _constraint(text_: str) -> tuple[QueryConstraint, ...]:
    return (QueryConstraint(sparql.parse(f"PREFIX r: <{NS}> PREFIX v: <{VOCAB}> " + text_)),)


@query(f"select distinct value as focus from ({_OUTSIDE})")
def shacl_scheme(t: Tables) -> DataFrame:
    shape = Shape(NS + "SegmentShape", ("objects", NS + "segment"), queries=_constraint("SELECT $this WHERE { FILTER NOT EXISTS { $this skos:inScheme v:SegmentScheme . } }"))
    return _validator(t.quads("customer")).results([shape]).select("focus")


@query(f"select distinct '{N}lineitem/' || l_orderkey || '-' || l_linenumber as focus from lineitem join orders on l_orderkey = o_orderkey where year(l_shipdate) < year(o_orderdate)")
def shacl_compare(t: Tables) -> DataFrame:
    ship = t.rows("child").select(F.concat(F.lit(N + "lineitem/"), "line_id").alias("s"), F.lit(NS + "shipYear").alias("p"), F.year("l_shipdate").cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD + "gYear").alias("o_dt"), F.lit(r.GRAPH + "child").alias("g"))
    shape = Shape(NS + "LineShape", ("subjects", NS + "partOf"), queries=_constraint("SELECT $this WHERE { $this r:shipYear ?ship ; r:partOf ?order . ?order r:year ?year . FILTER (?ship < ?year) }"))
    return _validator(union_graphs(t.quads("child", "wide"), ship)).results([shape]).select("focus")


@query(f"select '{N}order/' || o_orderkey as focus from orders where o_orderkey % 2 = 0 and o_orderkey % 3 <> 0")
def shacl_not_exists(t: Tables) -> DataFrame:
    mark = lambda n, name: t.orders.where(F.col("o_orderkey") % n == 0).select(F.concat(F.lit(N + "order/"), "o_orderkey").alias("s"), F.lit(NS + name).alias("p"), F.lit("1999").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD + "gYear").alias("o_dt"), F.lit("g").alias("g"))
    quads = union_graphs(t.quads("wide"), mark(2, "end"), mark(3, "start"))
    return _validator(quads).results([_order_shape(queries=_constraint("SELECT $this WHERE { $this r:end ?end . FILTER NOT EXISTS { $this r:start ?start . } }"))]).select("focus")


def _checked(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Parts of the orders, and results in which few parts are whole: dear orders of 1995 violate, cheap ones of the first parts warn."""
    rows = _parts(t).withColumn("year", F.year("o_orderdate"))
    rows = rows.withColumns({"o_orderpriority": F.when((F.col("o_orderkey") % 1700 == 3), F.lit(None)).otherwise(F.col("o_orderpriority")), "year": F.when(F.col("o_orderkey") % 2900 == 7, F.lit(12)).otherwise(F.col("year"))})
    quads = map_rows(rows, r.WIDE, r.GRAPH + "wide", "part_index")
    shape = _order_shape(PropertyShape(NS + "priority", 1, node_kind="iri"), PropertyShape(NS + "year", datatype=XSD + "gYear", severity="Warning"))
    return rows, _validator(quads, ("part_index",)).results([shape])


_COUNTS = f"(select part_index, count_if(o_orderkey % 1700 = 3)::bigint as violations, count_if(o_orderkey % 2900 = 7)::bigint as warnings from {_PARTS} group by 1)"


@query(f"select part_index, violations, warnings from {_COUNTS} where violations + warnings > 0")
def severity_counts(t: Tables) -> DataFrame:
    return shacl.severity_counts(_checked(t)[1], "part_index")


@query(f"select part_index, violations, warnings, violations + warnings = 0 as conforms, case when violations + warnings = 0 then 'asserted' else 'quarantine' end as zone from {_COUNTS}")
def part_gate(t: Tables) -> DataFrame:
    rows, results = _checked(t)
    return shacl.gate(rows, results)


@query(
    f"with c as {_COUNTS}, n as (select count(*)::bigint as total, count_if(violations + warnings = 0)::bigint as good from c) "
    "select 'orders' as transform, case when total = 0 then 'skipped-no-parts' when good = total then 'passed' when good = 0 then 'failed' else 'failed-partial' end as status, total as parts_total, good as conformant, total - good as quarantined from n "
    "union all select 'no-shapes', case when total = 0 then 'skipped-no-parts' else 'passed-no-shapes' end, total, total, 0 from n union all select 'no-parts', 'skipped-no-parts', 0, 0, 0"
)
def validation_status(t: Tables) -> DataFrame:
    rows, results = _checked(t)
    gated = shacl.gate(rows, results).withColumn("transform", F.lit("orders"))
    vacuous = rows.select("part_index").distinct().select(F.lit(0).cast("long").alias("violations"), F.lit(0).cast("long").alias("warnings"), F.lit(True).alias("conforms"), F.lit("asserted").alias("zone"), "part_index", F.lit("no-shapes").alias("transform"))
    transforms = t.spark.createDataFrame([("orders", True), ("no-shapes", False), ("no-parts", True)], "transform string, has_shapes boolean")
    return shacl.status(gated.unionByName(vacuous), transforms)


@query(
    f"select part_index, '{N}order/' || o_orderkey as focus, 'minCount' as component, 'Violation' as severity, '{NS}priority' as path from {_PARTS} where o_orderkey % 1700 = 3 union all "
    f"select part_index, '{N}order/' || o_orderkey, 'datatype', 'Warning', '{NS}year' from {_PARTS} where o_orderkey % 2900 = 7"
)
def validation_report(t: Tables) -> DataFrame:
    return _checked(t)[1].select("part_index", "focus", "component", "severity", "path")


@query(f"select '{N}order/' || o_orderkey as focus, case when o_orderkey % 2900 = 7 then 'a year has four digits' end as message from orders where o_orderkey % 2900 = 7 or o_orderkey % 1700 = 3")
def shacl_message(t: Tables) -> DataFrame:
    """A property's message where it has one, else none."""
    rows = t.rows("wide").withColumns({"o_orderpriority": F.when(F.col("o_orderkey") % 1700 == 3, F.lit(None)).otherwise(F.col("o_orderpriority")), "year": F.when(F.col("o_orderkey") % 2900 == 7, F.lit(12)).otherwise(F.year("o_orderdate"))})
    shape = _order_shape(PropertyShape(NS + "priority", 1), PropertyShape(NS + "year", datatype=XSD + "gYear", message="a year has four digits"))
    return _validator(map_rows(rows, r.WIDE, r.GRAPH + "wide")).results([shape]).select("focus", F.nullif("message", F.lit("")).alias("message"))


_LINE = f"'[] a <{SH}ValidationResult> ; <{SH}focusNode> <' || focus || '> ; <{SH}sourceShape> <{NS}OrderShape> ; <{SH}resultPath> <' || path || '> ; <{SH}sourceConstraintComponent> <{SH}' || upper(component[1]) || component[2:] || 'ConstraintComponent> ; <{SH}resultSeverity> <{SH}' || severity || '>'"


@query(f"select {_LINE} || case component when 'datatype' then ' ; <{SH}value> \"12\"' else '' end || ' .' as line from ({ORACLES['validation_report']})")
def report_turtle(t: Tables) -> DataFrame:
    return shacl.report_lines(_checked(t)[1])


@query(ORACLES["map_child"])
def nquads_files(t: Tables) -> DataFrame:
    """Quads written as text, in a folder a predicate, and read again."""
    path = _shared_dir(t)
    nquads.write(t.quads("child").withColumn("part", F.substring_index("p", "#", -1)), path, "part")
    return nquads.read(t.spark, path, shared_labels=True).select("s", "p", "o", "o_kind")


# ---- rules and closures

_RULE = f"""<{NS}PriceyRule> a sh:NodeShape ; sh:targetClass <{NS}Part> ; sh:rule [ a sh:SPARQLRule ;
  sh:construct "PREFIX r: <{NS}> CONSTRUCT {{ $this rdf:type r:Pricey . }} WHERE {{ $this r:price ?p ; r:size ?v . FILTER (?p >= 950.0 && ?v >= 25) }}" ] ."""


@query(f"select '{N}part/' || p_partkey as s, '{RDF}type' as p, '{NS}Pricey' as o from part where p_retailprice >= 950 and p_size >= 25 and p_partkey % 3 <> 0")
def rule_threshold(t: Tables) -> DataFrame:
    """A third of the parts are of no class: they meet the thresholds and are no focus of the rule."""
    typed = t.part.where("p_partkey % 3 <> 0").select(terms.entity_iri(N + "part/", F.col("p_partkey")).alias("s"), F.lit(RDF + "type").alias("p"), F.lit(NS + "Part").alias("o"), F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"))
    quads = t.quads("ratings").select("s", "p", "o", "o_kind", "o_dt").unionByName(typed)
    return rules.apply_rules(quads, shapes.read(_RULE), r.GRAPH + "inferred").select("s", "p", "o")


@query(f"select distinct '{N}order/' || l_orderkey as s, '{N}lineitem/' || l_orderkey || '-' || l_linenumber as o from lineitem")
def rule_inverse(t: Tables) -> DataFrame:
    return rules.inverse(t.quads("child"), NS + "hasLine", NS + "partOf", r.GRAPH + "inferred").select("s", "o")


@query(f"with x as (select distinct l_partkey, l_orderkey from lineitem) select distinct '{N}part/' || a.l_partkey as a, '{N}part/' || b.l_partkey as b from x a join x b on a.l_orderkey = b.l_orderkey and a.l_partkey <> b.l_partkey")
def rule_coactor(t: Tables) -> DataFrame:
    return rules.symmetric_pairs(t.quads("sold"), NS + "soldWith", NS + "soldIn", r.GRAPH + "inferred").select(F.col("s").alias("a"), F.col("o").alias("b"))


@query(f"select distinct '{N}customer/' || o_custkey as customer, '{VOCAB}' || {_SLUG.format('o_orderpriority')} as concept from orders")
def rule_chain(t: Tables) -> DataFrame:
    return rules.chain(t.quads("placed", "wide"), NS + "usedPriority", NS + "placed", NS + "priority", r.GRAPH + "inferred").select(F.col("s").alias("customer"), F.col("o").alias("concept"))


@query(f"select '{N}order/' || l_orderkey as s, '{NS}BigOrder' as o from lineitem group by l_orderkey having count(distinct l_partkey) >= 8")
def rule_crossover(t: Tables) -> DataFrame:
    return rules.at_least(t.quads("sold"), NS + "soldIn", 8, RDF + "type", NS + "BigOrder", r.GRAPH + "inferred").select("s", "o")


@query(f"select distinct '{N}lineitem/' || line_id as s, '{NS}Line' as o from {_CHILD} union select '{N}order/' || l_orderkey, '{NS}Order' from lineitem")
def domain_range(t: Tables) -> DataFrame:
    """Numbers have a range too, which types no literal."""
    ontology = [(NS + "partOf", RDFS + "domain", NS + "Line"), (NS + "partOf", RDFS + "range", NS + "Order"), (NS + "quantity", RDFS + "domain", NS + "Line"), (NS + "quantity", RDFS + "range", NS + "Amount")]
    return rules.typed_by_ends(t.quads("child"), ontology, r.GRAPH + "inferred").select("s", "o")


@query("select n_name as sub, r_name as sup from nation join region on n_regionkey = r_regionkey union all select n_name, 'WORLD' from nation union all select r_name, 'WORLD' from region")
def subclass_closure(t: Tables) -> DataFrame:
    edges = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("sub"), F.col("r_name").alias("sup")).unionByName(t.region.select(F.col("r_name").alias("sub"), F.lit("WORLD").alias("sup")))
    return rules.closure(edges)


@query(f"select p, count(*)::bigint as n from ({ORACLES['map_child']}) where p in ('{NS}quantity', '{NS}lineNumber') group by 1")
def subproperty_query(t: Tables) -> DataFrame:
    return rules.with_subproperties(t.quads("child"), NS + "number", r.SUBPROPERTIES).groupBy("p").agg(F.count("*").alias("n"))


# ---- lineage

_STEPS = (
    "select 'http://example.org/activities/' || n_nationkey as a, 'http://example.org/data/' || n_regionkey as i, 'http://example.org/data/out/' || n_name as o, 'http://example.org/agents/x' as g, 'map@v' || n_regionkey as spec, case when n_nationkey % 2 = 0 then n_nationkey::varchar end as n, "
    "strftime(timestamp '2024-01-01 00:00:00' + to_minutes(n_nationkey), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as t from nation"
)


def _steps(t: Tables) -> DataFrame:
    c, lit = F.col, F.lit
    at = F.timestamp_micros(lit(1704067200000000) + c("n_nationkey").cast("long") * 60000000)
    return t.nation.select(
        F.concat(lit("40-"), "n_name").alias("slug"),
        F.concat(lit("http://example.org/activities/"), "n_nationkey").alias("activity"),
        lit("http://example.org/agents/x").alias("agent"),
        F.concat(lit("http://example.org/data/"), "n_regionkey").alias("input"),
        F.concat(lit("http://example.org/data/out/"), "n_name").alias("output"),
        F.concat(lit("map@v"), "n_regionkey").alias("transform_spec"),
        at.alias("started_at"),
        at.alias("ended_at"),
        F.when(c("n_nationkey") % 2 == 0, c("n_nationkey").cast("long")).alias("record_count"),
        lit(None).cast("string").alias("input_type"),
        lit(PIPELINE + "NamedGraph").alias("output_type"),
    )


def _sql_triples(rows: list[tuple[str, str, str]], source: str) -> str:
    return "select distinct s, p, o from (" + " union all ".join(f"select {s} as s, '{p}' as p, {o} as o from x" for s, p, o in rows) + ") where o is not null" if not source else f"with x as ({source}) " + _sql_triples(rows, "")


_DERIVED = [
    ("i", RDF + "type", f"'{PROV}Entity'"),
    ("o", RDF + "type", f"'{PIPELINE}NamedGraph'"),
    ("o", RDF + "type", f"'{PROV}Entity'"),
    ("a", RDF + "type", f"'{PROV}Activity'"),
    ("a", PROV + "used", "i"),
    ("a", PROV + "generated", "o"),
    ("a", PROV + "wasAssociatedWith", "g"),
    ("a", PROV + "startedAtTime", "t"),
    ("a", PROV + "endedAtTime", "t"),
    ("o", PROV + "wasGeneratedBy", "a"),
    ("o", PROV + "wasDerivedFrom", "i"),
    ("o", PROV + "qualifiedGeneration", "o || '/generation'"),
    ("o || '/generation'", RDF + "type", f"'{PROV}Generation'"),
    ("o || '/generation'", PROV + "entity", "o"),
    ("o || '/generation'", PROV + "activity", "a"),
    ("o || '/generation'", PIPELINE + "transformSpec", "spec"),
    ("o || '/generation'", PIPELINE + "recordCount", "n"),
]
_PROV_GRAPH = lineage.graph_of("retail", "b1")


@query(_sql_triples(_DERIVED, _STEPS))
def prov_derivation(t: Tables) -> DataFrame:
    return lineage.derivations(_steps(t), _PROV_GRAPH).select("s", "p", "o")


_BATCH = "select 'http://example.org/data/source/' || r_name as src, 'http://example.org/data/' || r_name || '/staging/b1' as b, 'http://example.org/agents/x' as g, 'http://example.org/activities/' || r_name as a, r_name as id, sha256(r_name) as fp from region"
_BEGUN = [
    ("src", RDF + "type", f"'{PIPELINE}DataSource'"),
    ("src", RDF + "type", f"'{PROV}Entity'"),
    ("src", PIPELINE + "sourceId", "id"),
    ("src", "http://www.w3.org/2000/01/rdf-schema#label", "id"),
    ("b", RDF + "type", f"'{PIPELINE}IngestBatch'"),
    ("b", RDF + "type", f"'{PROV}Entity'"),
    ("b", PIPELINE + "batchId", "'b1'"),
    ("b", PIPELINE + "sourceFingerprint", "fp"),
    ("b", PROV + "wasDerivedFrom", "src"),
    ("b", PROV + "wasGeneratedBy", "a"),
    ("g", RDF + "type", f"'{PROV}SoftwareAgent'"),
    ("g", "http://www.w3.org/2000/01/rdf-schema#label", "'flow:' || id"),
    ("a", RDF + "type", f"'{PROV}Activity'"),
    ("a", PROV + "generated", "b"),
    ("a", PROV + "wasAssociatedWith", "g"),
    ("a", PROV + "startedAtTime", "'2024-01-01T00:00:00.000000Z'"),
]


def _batches(t: Tables) -> DataFrame:
    name = F.col("r_name")
    return t.region.select(
        F.concat(F.lit("http://example.org/data/"), name, F.lit("/staging/b1")).alias("batch"),
        F.concat(F.lit("http://example.org/data/source/"), name).alias("source"),
        F.lit("http://example.org/agents/x").alias("agent"),
        F.concat(F.lit("http://example.org/activities/"), name).alias("activity"),
        name.alias("source_id"),
        F.lit("b1").alias("batch_id"),
        name.alias("label"),
        F.sha2(name, 256).alias("fingerprint"),
        F.timestamp_micros(F.lit(1704067200000000)).alias("started_at"),
    )


@query(_sql_triples(_BEGUN, _BATCH))
def prov_batch(t: Tables) -> DataFrame:
    return lineage.batch_start(_batches(t), _PROV_GRAPH).select("s", "p", "o")


@query(f"select distinct s, p, o, '{_PROV_GRAPH}' as g from (({_sql_triples(_DERIVED, _STEPS)}) union all ({_sql_triples(_BEGUN, _BATCH)}))")
def prov_consolidate(t: Tables) -> DataFrame:
    """Fragments overlap, and one is in the default graph, which stays out."""
    a, b = lineage.derivations(_steps(t), _PROV_GRAPH), lineage.batch_start(_batches(t), _PROV_GRAPH)
    default = b.withColumns({"g": F.lit("urn:x-rdflib:default"), "s": F.lit("http://example.org/nowhere")})
    return lineage.consolidate(_PROV_GRAPH, a, b, a.where(F.col("p") == PROV + "used"), default).select("s", "p", "o", "g")


@query(
    "with recursive e as (select conv_id || '-' || turn as start, conv_id || '-' || (turn - 1) as parent from conversations where turn > 0), "
    "w as (select start, parent as ancestor, 1::bigint as depth from e union all select w.start, e.parent, w.depth + 1 from w join e on w.ancestor = e.start) select start, ancestor, depth from w"
)
def prov_trace(t: Tables) -> DataFrame:
    name = lambda turn: F.concat_ws("-", "conv_id", turn)
    return lineage.trace(t.conversations.where("turn > 0").select(name(F.col("turn")).alias("start"), name(F.col("turn") - 1).alias("parent")))


def template_catalog() -> str:
    """All templates, as the side-car file lists them."""
    from .plans import templates

    return json.dumps(templates.catalog([x for name in sorted(templates.TEXTS) for x in templates.builtin(name).templates]))
