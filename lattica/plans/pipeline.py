"""The whole run: stage, templates, materialize, validate, finalize.

Rows stay in Spark from the reader to the quad store; the driver holds paths,
configuration and one row a part. Side-car files are JSON and TriG beside the
batch. Each step is timed around its action and recorded once.
"""

from __future__ import annotations

import json
import shutil
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.terms import ZONES
from ..operators import lineage, shacl
from ..operators.mapping import losses, map_rows
from ..operators.quads import in_scan_order, part_of, part_stats
from ..sources import fingerprint, nquads, tsv
from ..sources.registry import SOURCES, Source, discover
from . import scope as scopes
from . import templates, vocabulary
from .scope import Step, Steps, take
from .shapes import BINDINGS, Bindings
from .vocabulary import BASE, PIPELINE, PROV


def stem(name: str) -> str:
    return name.removesuffix(".gz").removesuffix(".tsv")


def _json(path: Path, data: dict) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data, indent=2, sort_keys=True) + "\n", encoding="utf-8")
    return path


def _load(path: Path) -> dict:
    return json.loads(path.read_text(encoding="utf-8")) if path.is_file() else {}


@dataclass
class Run:
    """One batch of one source. ``class_scope`` part or dataset: whether class checks see other graphs."""

    spark: SparkSession
    raw: Path
    staging: Path
    source: Source = field(default_factory=lambda: SOURCES["imdb"])
    steps: Steps = field(default_factory=scopes.builtin)
    bindings: Bindings = BINDINGS
    batch_id: str | None = None
    class_scope: str = "part"
    allow_warnings: bool = False
    separators: str | None = None
    strict: bool = False

    def __post_init__(self) -> None:
        self.files = discover(self.source, self.raw)
        self.hashes = {f.name: fingerprint.file_sha256(f) for f in self.files}
        self.digest, own = fingerprint.combined(self.hashes)
        self.batch_id = self.batch_id or own
        self.dir = self.staging / self.batch_id
        self.graph = lineage.graph_of(self.source.id, self.batch_id)
        self.agent = f"{BASE}agents/spark/flow/{self.spark.sparkContext.applicationId}"

    # names
    def entity(self, *parts: str) -> str:
        return "/".join([f"{BASE}data/{self.source.id}/staging/{self.batch_id}", *parts])

    def graph_iri(self, transform: Step, zone: str = "asserted") -> str:
        return f"{BASE}graph/{zone}/{self.source.id}/{self.batch_id}/{stem(transform.file)}"

    def quads_dir(self, transform: Step, zone: str) -> Path:
        return self.dir / "graphs" / zone / stem(transform.file)

    # lineage
    def record(self, slug: str, input_: str, output: str, spec: str, began: datetime, count: int | None = None, type_: str | None = None, overwrite: bool = True) -> None:
        """One fragment a step; an existing one stays unless overwritten."""
        path = self.dir / "provenance" / "fragments" / f"{slug}.json"
        if path.exists() and not overwrite:
            return
        _json(path, {"slug": slug, "activity": f"{BASE}activities/spark/task/{uuid.uuid4()}", "agent": self.agent, "input": input_, "output": output, "transform_spec": spec, "started_at": began.isoformat(), "ended_at": datetime.now(UTC).isoformat(), "record_count": count, "input_type": None, "output_type": type_})

    # steps
    def stage(self) -> dict:
        """Land changed files, profile them under their hash and dialect, write the manifest."""
        (self.dir / "raw").mkdir(parents=True, exist_ok=True)
        before = {e["file"]: e for e in _load(self.dir / "manifest.json").get("files", [])}
        entries = []
        for f in self.files:
            began, dest, known = datetime.now(UTC), self.dir / "raw" / f.name, before.get(f.name, {})
            if not (dest.exists() and known.get("content_hash") == self.hashes[f.name]):
                shutil.copy2(f, dest)
                self.record(f"10-land-{f.name}", f"{BASE}data/{self.source.id}/raw/{f.name}", self.entity("raw", f.name), "land@v1", began, type_=PIPELINE + "StagedFile")
            if known.get("content_hash") == self.hashes[f.name] and known.get("dialect") == tsv.DIALECT_HASH:
                entries.append(known)
                continue
            began = datetime.now(UTC)
            row = tsv.profile(tsv.read_source(self.spark, self.source, dest), f.name, self.hashes[f.name], dest.stat().st_size).first().asDict()
            entries.append(row | {"staged_path": f"raw/{f.name}"})
            self.record(f"20-profile-{f.name}", self.entity("raw", f.name), self.entity("profiles", stem(f.name)), "profile@v1", began, row["row_count"], PIPELINE + "ProfileReport")
        manifest = {"source_id": self.source.id, "batch_id": self.batch_id, "source_fingerprint": self.digest, "file_count": len(entries), "row_count": sum(e["row_count"] for e in entries), "files": entries}
        _json(self.dir / "manifest.json", manifest)
        return manifest

    def templates(self, only: list[str] | None = None) -> dict:
        began, chosen = datetime.now(UTC), take(self.steps, only)
        found = [t for x in chosen for t in templates.builtin(x.name).templates]
        listing = templates.catalog(found)
        _json(self.dir / "templates" / "catalog.json", listing)
        layout = {t.name: {"graph_iri": self.graph_iri(t)} | {z: f"graphs/{z}/{stem(t.file)}" for z in ZONES} for t in chosen}
        for t in chosen:
            for z in ZONES:
                self.quads_dir(t, z).mkdir(parents=True, exist_ok=True)
        _json(self.dir / "graphs" / "layout.json", layout)
        self.record("30-load-templates", self.entity(), self.entity("templates", "catalog"), "load-templates@v1", began, len(found), PIPELINE + "OttrTemplateCatalog")
        return listing

    def _mapping(self, t: Step) -> templates.Mapping:
        m = templates.builtin(t.name)
        if self.separators is None:
            return m
        from dataclasses import replace

        return replace(m, fields={k: replace(f, separators=self.separators) if f.kind == "concept" else f for k, f in m.fields.items()})

    def quads(self, t: Step) -> tuple[DataFrame, DataFrame]:
        """(rows with row_ord and part_index, quads) of a transform."""
        rows = in_scan_order(tsv.read_source(self.spark, self.source, self.raw / t.file)).withColumn("part_index", part_of(F.col("row_ord"), t.part_rows))
        return rows, map_rows(rows, self._mapping(t), self.graph_iri(t), "part_index", "row_ord", strict=self.strict)

    def materialize(self, only: list[str] | None = None) -> list[dict]:
        out = []
        for t in take(self.steps, only):
            began, work = datetime.now(UTC), self.quads_dir(t, "work")
            key = {"input_hash": self.hashes[t.file], "transform_spec": t.version, "mapping": repr(self._mapping(t)), "chunk_rows": t.part_rows}
            known = _load(work / "chunks.json")
            if known and all(known.get(k) == v for k, v in key.items()) and (work / "quads").is_dir():
                out.append(known | {"transform_id": t.name, "skipped": True})
                continue
            rows, quads = self.quads(t)
            quads.write.mode("overwrite").partitionBy("part_index").parquet(str(work / "quads"))
            stored = self.read(t, "work")
            parts = [r.asDict() for r in part_stats(rows, stored).orderBy("part_index").collect()]
            stats = key | {"parts": parts, "total_rows": sum(p["rows"] for p in parts), "total_triples": sum(p["triples"] for p in parts), "left_out": losses(rows, self._mapping(t))}
            _json(work / "chunks.json", stats)
            self.record(f"40-materialize-{t.name}", self.entity("raw", t.file), self.graph_iri(t, "work"), t.version, began, stats["total_rows"], PIPELINE + "NamedGraph")
            out.append(stats | {"transform_id": t.name, "skipped": False})
        return out

    def read(self, t: Step, zone: str) -> DataFrame:
        return self.spark.read.schema("s string, p string, o string, o_kind string, o_dt string, g string, row_ord long, part_index int").parquet(str(self.quads_dir(t, zone) / "quads"))

    def context(self) -> DataFrame | None:
        """Type quads of everything materialized, for class checks over the whole dataset."""
        out = None
        for t in take(self.steps):
            if (self.quads_dir(t, "work") / "quads").is_dir():
                typed = self.read(t, "work").where(F.col("p") == vocabulary.RDF + "type").select("s", "p", "o")
                out = typed if out is None else out.unionByName(typed)
        return out

    def validate(self, only: list[str] | None = None) -> list[dict]:
        """Check each part, move it whole to its zone, and report."""
        ontology, out = vocabulary.ontology_triples(), []
        for t in take(self.steps, only):
            began, shapes = datetime.now(UTC), self.bindings.shapes(t.name)
            made = _load(self.quads_dir(t, "work") / "chunks.json")
            parts = made.get("parts", [])
            gated, results, quads = [], None, None
            if parts:
                quads = self.read(t, "work").cache()
                every = self.spark.createDataFrame([(p["part_index"],) for p in parts], "part_index int")
                results = shacl.Validator(quads, ontology, context=self.context() if self.class_scope == "dataset" else None).results(shapes).cache()
                gated = [r.asDict() for r in shacl.gate(every, results, allow_warnings=self.allow_warnings).orderBy("part_index").collect()]
            ok = [g["part_index"] for g in gated if g["conforms"]]
            for zone, members in (("asserted", ok), ("quarantine", [g["part_index"] for g in gated if not g["conforms"]])):
                target = self.quads_dir(t, zone)
                shutil.rmtree(target / "quads", ignore_errors=True)
                shutil.rmtree(target / "nquads", ignore_errors=True)
                if members:
                    zoned = quads.where(F.col("part_index").isin(members))
                    zoned.write.mode("overwrite").partitionBy("part_index").parquet(str(target / "quads"))
                    nquads.write(zoned, str(target / "nquads"), "part_index")
                    triples = {p["part_index"]: p for p in parts}
                    _json(target / "chunks.json", {"transform_id": t.name, "parts": [triples[m] for m in members]})
                    self.record(f"50-validate-{t.name}" + ("" if zone == "asserted" else "-quarantine"), self.graph_iri(t, "work"), self.graph_iri(t, zone), f"validate-{t.name}@v1", began, sum(triples[m]["triples"] for m in members), PIPELINE + "NamedGraph")
            n, good = len(gated), len(ok)
            word = "skipped-no-parts" if not n else ("passed" if shapes else "passed-no-shapes") if good == n else "failed" if not good else "failed-partial"
            report = {"transform_id": t.name, "graph_iri": self.graph_iri(t), "status": word, "engine": "lattica", "validated_at": datetime.now(UTC).isoformat(), "parts_total": n, "parts_conformant": good, "parts_quarantined": n - good, "violations": sum(g["violations"] for g in gated), "warnings": sum(g["warnings"] for g in gated), "left_out": made.get("left_out", {}), "shapes": self.bindings.names(t.name), "parts": gated}
            folder = self.quads_dir(t, "reports")
            _json(folder / "validation.json", report)
            if results is not None and (n > good or report["warnings"]):
                results.write.mode("overwrite").parquet(str(folder / "results"))
                shacl.report_lines(results).write.mode("overwrite").text(str(folder / "shacl"))
            if quads is not None:
                quads.unpersist()
                results.unpersist()
            out.append(report)
        return out

    def finalize(self) -> Path:
        """All fragments as one set of quads in one TriG file."""
        steps = [_load(p) for p in sorted((self.dir / "provenance" / "fragments").glob("*.json"))]
        names = [c.split()[0] for c in lineage.STEP.split(", ")]
        time = lambda x: datetime.fromisoformat(x) if isinstance(x, str) else x
        rows = [tuple(time(s[n]) if n.endswith("_at") else s[n] for n in names) for s in steps]
        start = self.spark.createDataFrame([(self.entity(), f"{BASE}data/source/{self.source.id}", self.agent, f"{self.agent}/init", self.source.id, self.batch_id, self.source.label, self.digest, datetime.now(UTC))], "batch string, source string, agent string, activity string, source_id string, batch_id string, label string, fingerprint string, started_at timestamp")
        quads = lineage.consolidate(self.graph, lineage.batch_start(start, self.graph), lineage.derivations(self.spark.createDataFrame(rows, lineage.STEP), self.graph))
        path = self.dir / "provenance" / "provenance.trig"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(lineage.to_trig(quads), encoding="utf-8")
        return path

    def ingest(self, only: list[str] | None = None, *, skip_staging: bool = False, skip_templates: bool = False, skip_materialize: bool = False, skip_validate: bool = False) -> dict:
        manifest = {} if skip_staging else self.stage()
        if not skip_templates:
            self.templates(only)
        made = [] if skip_materialize else self.materialize(only)
        checked = [] if skip_validate or not made else self.validate(only)
        return {"source_id": self.source.id, "batch_id": self.batch_id, "batch_dir": str(self.dir), "file_count": len(self.files), "row_count": manifest.get("row_count"), "transforms": checked, "total_triples": sum(m["total_triples"] for m in made), "provenance_path": str(self.finalize()), "agent_type": PROV + "SoftwareAgent"}
