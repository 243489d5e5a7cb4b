"""A whole run over hand-made files: stage, materialize, gate, lineage, and a second run that has nothing to do."""

import gzip
import json
from dataclasses import replace

import pytest

from lattica import cli
from lattica.plans import scope, turtle
from lattica.plans.pipeline import Run

FILES = {
    "title.ratings.tsv.gz": ["tconst\taverageRating\tnumVotes", "tt1\t8.4\t1500", "tt2\t\\N\t999"],
    "title.akas.tsv.gz": ["titleId\tordering\ttitle\tregion\tlanguage\ttypes\tattributes\tisOriginalTitle", 'tt1\t1\tFred "The" X\t\\N\t\\N\t\\N\t\\N\t0', "tt1\t2\tback\\slash\t\\N\t\\N\t\\N\t\\N\t0", 'tt1\t3\t"unbalanced\t\\N\t\\N\t\\N\t\\N\t0', "tt1\t4\t\\N\t\\N\t\\N\t\\N\t\\N\t0", "tt1\t5\t  \t\\N\t\\N\t\\N\t\\N\t0"],
    "title.basics.tsv.gz": ["tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres", *[f"tt{i}\tmovie\tT{i}\tT{i}\t0\t{2000 if i != 1200 else 12}\t\\N\t90\tDrama" for i in range(2500)]],
    "title.crew.tsv.gz": ["tconst\tdirectors\twriters", "tt1\tnm1,nm2\t\\N"],
    "title.episode.tsv.gz": ["tconst\tparentTconst\tseasonNumber\tepisodeNumber", "tt10\ttt11\t1\t2"],
    "name.basics.tsv.gz": ["nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles"],
}


@pytest.fixture
def folders(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, lines in FILES.items():
        (raw / name).write_bytes(gzip.compress(("\n".join(lines) + "\n").encode(), mtime=0))
    return raw, tmp_path / "staging"


def test_run(spark, folders):
    small = scope.builtin(part_rows=1000)
    run = Run(spark, *folders, steps=small)
    result = run.ingest()
    status = {r["transform_id"]: (r["status"], r["parts_total"], r["parts_conformant"]) for r in result["transforms"]}
    assert status == {"name-basics": ("skipped-no-parts", 0, 0), "title-akas": ("passed-no-shapes", 1, 1), "title-basics": ("failed-partial", 3, 2), "title-episode": ("failed", 1, 0), "title-ratings": ("passed-no-shapes", 1, 1)}
    manifest = json.loads((run.dir / "manifest.json").read_text())
    assert manifest["file_count"] == 6 and {f["file"]: f["row_count"] for f in manifest["files"]} == {n: len(x) - 1 for n, x in FILES.items()}
    assert manifest["batch_id"] == manifest["source_fingerprint"][:16] == run.batch_id
    akas = spark.read.text(str(run.quads_dir(small["title-akas"], "asserted") / "nquads")).collect()
    assert sorted(r["value"].split('"', 1)[1].rsplit('"', 1)[0] for r in akas) == sorted(['Fred \\"The\\" X', "back\\\\slash", '\\"unbalanced'])
    basics = small["title-basics"]
    work = run.read(basics, "work").count()
    zones = [run.read(basics, z) for z in ("asserted", "quarantine")]
    assert sum(z.count() for z in zones) == work == 2500 * 8
    assert [r[0] for r in zones[1].select("part_index").distinct().collect()] == [1]
    report = "\n".join(r["value"] for r in spark.read.text(str(run.quads_dir(basics, "reports") / "shacl")).collect())
    told = turtle.parse(report)
    assert {o[1].rsplit("#", 1)[-1] for _, p, o, _ in told if p[1].endswith("sourceConstraintComponent")} == {"DatatypeConstraintComponent"}
    assert [o[1] for _, p, o, _ in told if p[1].endswith("focusNode")] == ["http://example.org/imdb/title/tt1200"]
    body = (run.dir / "provenance" / "provenance.trig").read_text()
    assert len({s for s, p, o, g in turtle.parse(body) if o[1].endswith("prov#Activity")}) >= 6 + 6 + 1 + 5
    assert result["total_triples"] == 3 + 3 + 2500 * 8 + 3

    again = Run(spark, *folders, steps=small)
    assert again.batch_id == run.batch_id and all(m["skipped"] for m in again.materialize())
    assert again.stage() == manifest
    whole = Run(spark, *folders, steps=small, class_scope="dataset")
    assert {r["transform_id"]: r["status"] for r in whole.validate(["title-episode"])} == {"title-episode": "passed"}


def test_cli(spark, folders, capsys):
    raw, staging = folders
    args = ["--raw", str(raw), "--staging", str(staging)]
    assert cli.main(["materialize", *args], spark) == 1
    assert cli.main(["stage", *args], spark) == 0
    assert cli.main(["materialize", *args, "--only", "title-ratings,unknown", "--validate"], spark) == 0
    assert cli.main(["validate", *args, "--only", "title-ratings"], spark) == 0
    out = capsys.readouterr().out
    assert "triples=3" in out and "title-ratings: passed-no-shapes (1 of 1 parts)" in out
    assert cli.main(["ingest", *args, "--batch-id", "mine", "--only", "title-akas"], spark) == 0
    assert (staging / "mine" / "provenance" / "provenance.trig").is_file()
