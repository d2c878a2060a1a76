"""Local and stored files: scans, text by type, tables by suffix, registry, cache and report sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinstone.functions.text import blank, strip_html
from veinstone.operators.evidence import keep_one


#: Fixed value: file names such as "(2021) Title".
YEAR_TITLE = r"^\((\d{4})\)\s*(.+)$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any store is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of the paths that is there."""
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {', '.join(paths)}")


def scan(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True, content: bool = False) -> DataFrame:
    """One row a file: id, path, year and title from names like "(2021) Title.pdf", length; contents are not read unless asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", "")
    year = F.regexp_extract(name, YEAR_TITLE, 1)
    out = files.select(F.substring(F.sha1(F.col("path").cast("binary")), 1, 20).alias("source_id"), "path", F.nullif(year, F.lit("")).cast("int").alias("year"), F.when(year != "", F.regexp_extract(name, YEAR_TITLE, 2)).otherwise(name).alias("title"), "length", *(["content"] if content else []))
    return out


def index(spark: SparkSession, roots: list[str], out: str, pattern: str = "*", most: int | None = None) -> dict:
    """Writes the scan of all roots as a table at `out`, without any search, and returns its manifest: files, roots and those that could not be read."""
    parts, bad = [], []
    for root in roots:
        if exists(spark, root):
            parts.append(scan(spark, root, pattern))
        else:
            bad.append(root)
    if not parts:
        raise FileNotFoundError(f"none of {', '.join(roots)}")
    every = keep_one(_union(parts), ["path"], [F.asc("source_id")])
    (every if most is None else every.orderBy("path").limit(most)).write.mode("overwrite").parquet(out)
    return {"roots": roots, "unreadable": bad, "files": spark.read.parquet(out).count()}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pdf_texts(files: DataFrame) -> DataFrame:
    """(path, text) of PDF files, page by page, by whichever of the public readers is installed; the longer text counts, blank without one."""

    def read(content: bytes) -> str:
        import io

        found = [""]
        try:
            from pypdf import PdfReader

            found.append("\n".join(page.extract_text() or "" for page in PdfReader(io.BytesIO(content)).pages))
        except Exception:  # not installed, or not a readable PDF
            pass
        try:
            from pdfminer.high_level import extract_text

            found.append(extract_text(io.BytesIO(content)))
        except Exception:
            pass
        return max(found, key=len)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "text": [read(bytes(c)) for c in batch["content"]]})

    return files.where(F.lower("path").endswith(".pdf")).select("path", "content").mapInPandas(run, "path string, text string")


def texts(files: DataFrame) -> DataFrame:
    """files (path, content) with mime by suffix, text_content, parse_status and content_hash."""
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    raw = F.decode("content", "UTF-8")
    text = F.when(suffix.isin("html", "htm", "xml"), strip_html(raw)).when(suffix.isin("txt", "md", "csv", "tsv"), raw).otherwise("")
    status = F.when(suffix.isin("html", "htm"), "parsed_html").when(suffix == "xml", "parsed_xml").when(suffix.isin("txt", "md", "csv", "tsv"), "parsed_text").otherwise("stored_binary")
    return files.withColumns({"text_content": text, "parse_status": status, "content_hash": F.sha2("content", 256)})


def table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix: Parquet, CSV or TSV."""
    low = path.lower().rstrip("/")
    if low.endswith(".parquet"):
        return spark.read.parquet(path)
    if low.endswith((".csv", ".tsv")):
        return spark.read.csv(path, header=True, inferSchema=True, sep="\t" if low.endswith(".tsv") else ",")
    raise ValueError(f"no table format for {path}")


#: Other spellings of gold columns, by the name that they get.
GOLD_NAMES = {"x_value": ("x", "x_value", "thickness_nm"), "y_value": ("y", "y_value", "temperature_c"), "entity": ("phase", "entity")}
CONTEXT_NAMES = {"substrate_material": ("substrate", "substrate_material"), "substrate_orientation": ("orientation", "substrate_orientation", "crystallographic_orientation"), "doping_state": ("doping", "doping_state"), "alloy_state": ("alloy", "alloy_state")}


def renamed(rows: DataFrame, names: dict[str, tuple[str, ...]]) -> DataFrame:
    """rows with columns called by other spellings renamed, of several the first listed."""
    low = {c.strip().lower(): c for c in reversed(rows.columns)}
    found = {name: next((low[x] for x in spelled if x in low), None) for name, spelled in names.items()}
    return rows.select("*", *[F.col(c).alias(f"__{name}") for name, c in found.items() if c]).drop(*{c for c in found.values() if c}, *[n for n, c in found.items() if c]).withColumnsRenamed({f"__{n}": n for n in found})


def gold(spark: SparkSession, folder: str, context: bool = False) -> DataFrame:
    """Gold points of a folder (gold_points.parquet, else gold_points.csv) or of a table: x_value, y_value, entity, and context fields, blank where absent."""
    path = folder if folder.lower().endswith((".parquet", ".csv", ".tsv")) else first_existing(spark, f"{folder}/gold_points.parquet", f"{folder}/gold_points.csv")
    rows = renamed(table(spark, path), GOLD_NAMES | (CONTEXT_NAMES if context else {}))
    if lost := [c for c in GOLD_NAMES if c not in rows.columns]:
        raise ValueError(f"gold table lacks {', '.join(lost)}")
    own = [F.col("x_value").cast("double").alias("x_value"), F.col("y_value").cast("double").alias("y_value"), "entity"]
    return rows.select(*own, *[blank(F.col(c).cast("string")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in (CONTEXT_NAMES if context else ())])


def predicted(spark: SparkSession, run: str, x: str = "thickness_nm", y: str = "temperature_c", order: str = "variable_name") -> DataFrame:
    """A run's points: its consensus, else its validated rows pivoted to points that have both variables."""
    if exists(spark, f"{run}/artifacts/consensus_points.parquet"):
        return spark.read.parquet(f"{run}/artifacts/consensus_points.parquet")
    rows = spark.read.parquet(first_existing(spark, f"{run}/artifacts/validated_points.parquet"))
    value = lambda v: F.min_by(F.when(F.col("variable_name") == v, F.col("normalized_value")), F.when(F.col("variable_name") == v, F.col(order)))
    first = [F.min_by(blank(F.col(c)), F.struct(order, c)).alias(c) for c in ("entity", *CONTEXT_NAMES) if c in rows.columns]
    return rows.groupBy("point_id").agg(value(x).alias("x_value"), value(y).alias("y_value"), *first).where("x_value is not null and y_value is not null")


def evidence_rows(spark: SparkSession, run: str) -> DataFrame:
    """The first of a run's tables that is there: training rows, phase events, validated points, evidence."""
    return table(spark, first_existing(spark, *[f"{run}/artifacts/{n}.parquet" for n in ("processor_training_rows", "phase_events", "validated_points", "evidence_points")]))


#: Where a system's own rows may lie in its folder, in order.
SYSTEM_FILES = tuple(f"{folder}{name}.parquet" for name in ("processor_training_rows", "validated_points", "evidence_points") for folder in ("artifacts/", ""))


def system_table(spark: SparkSession, path: str) -> DataFrame:
    """A system's own rows: a table by its suffix, or the first known file of a folder."""
    return table(spark, path if path.lower().endswith((".parquet", ".csv", ".tsv")) else first_existing(spark, *[f"{path.rstrip('/')}/{f}" for f in SYSTEM_FILES]))


def specification(text: str) -> dict:
    """A topic specification from JSON, or YAML where a reader of it is installed; checked for an id and variables."""
    try:
        spec = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as e:
            raise ValueError("the specification is not JSON, and no YAML reader is installed") from e
        spec = yaml.safe_load(text)
    if not isinstance(spec, dict) or not str(spec.get("topic_id") or "").strip():
        raise ValueError("a specification needs a topic_id")
    if not spec.get("variables"):
        raise ValueError("a specification needs a variable")
    return spec


def query_of(spec: dict, query: str | None = None) -> str:
    """The query as given, else the specification's question or keywords."""
    for own in (query, spec.get("question_template"), " ".join(spec.get("keywords") or [])):
        if own and own.strip():
            return own.strip()
    raise ValueError("no query, question or keywords")


class Registry:
    """Runs, artifacts and lineage of a run directory, as append-only Parquet tables; the last entry of a key counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def artifact(self, run_id: str, name: str, path: str, parents: list[str] = ()) -> None:
        now = F.current_timestamp()
        one = self.spark.range(1)
        one.select(F.lit(run_id).alias("run_id"), F.lit(name).alias("name"), F.lit(path).alias("path"), now.alias("at")).write.mode("append").parquet(f"{self.root}/state/artifacts")
        if parents:
            one.select(F.explode(F.array(*[F.lit(p) for p in parents])).alias("parent")).select(F.lit(run_id).alias("run_id"), "parent", F.lit(name).alias("child"), now.alias("at")).write.mode("append").parquet(f"{self.root}/state/lineage")

    def artifacts(self) -> DataFrame:
        return keep_one(self.spark.read.parquet(f"{self.root}/state/artifacts"), ["run_id", "name"], [F.desc("at"), F.desc("path")])

    def lineage(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/state/lineage")

    def save(self, rows: DataFrame, run_id: str, name: str, parents: list[str] = ()) -> DataFrame:
        path = f"{self.root}/artifacts/{name}.parquet"
        rows.write.mode("overwrite").parquet(path)
        self.artifact(run_id, name, path, list(parents))
        return self.spark.read.parquet(path)


#: The columns of the citation table.
CITATION = tuple("point_id entity x_value y_value substrate_material substrate_orientation doping_state alloy_state model_confidence entropy display_alpha mp_status mp_best_material_id mp_interpretation_score mp_interpretation_label mp_conflict_reason doi citation_url locator".split())


def citations(rows: DataFrame, path: str) -> None:
    """The citation table as CSV; absent columns and nulls are empty."""
    rows.select(*[blank(F.col(c).cast("string")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in CITATION]).write.mode("overwrite").csv(path, header=True)


def claims(points: DataFrame, x: str, y: str, order: str, most: int = 20) -> DataFrame:
    """(claim, citation) of the first consensus points by order."""
    text = F.format_string("At %s=%s, entity %s observed near %s=%s (consensus %s, entropy %.3f).", F.lit(x), F.col("x_value").cast("string"), F.col("entity"), F.lit(y), F.col("y_value").cast("string"), F.col("consensus_entity"), F.col("entropy").cast("double"))
    return points.orderBy(order).limit(most).select(text.alias("claim"), blank(F.col("citation_url")).alias("citation"))


def recipe_claims(ranked: DataFrame, order: str, most: int = 20) -> DataFrame:
    """The same of ranked recipes, for runs without points."""
    text = F.format_string("Recipe %s targets %s with %s anneal at %.2f C for %.2f s (score %.3f).", "recipe_id", "target_film_material", "method_family", "anneal_temperature_c", "anneal_time_s", "weighted")
    return ranked.orderBy(order).limit(most).select(text.alias("claim"), blank(F.col("citation_url")).alias("citation"))


def handoff(found: DataFrame, artifacts: list[str]) -> dict:
    """The hand-off document of at most a few claims: valid if there are any, pending otherwise."""
    rows = [r.asDict() for r in found.limit(20).collect()]
    return {"schema_version": "3.0", "status": "VALID" if rows else "PENDING", "artifacts": artifacts, "claims_with_citations": rows, "risks": []}


#: Colours of entities in plots, in order of name.
PALETTE = ("#1b9e77", "#d95f02", "#7570b3", "#e7298a", "#66a61e", "#e6ab02", "#a6761d", "#666666")


def colours(entities: list[str]) -> dict[str, str]:
    return {e: PALETTE[k % len(PALETTE)] for k, e in enumerate(sorted(set(entities)))}


def scatter(points: DataFrame, curve: DataFrame, path: str, most: int = 5000) -> bool:
    """A scatter plot of at most `most` points (the rest by a fixed sample, since a plot shows no more) with the consensus curve; false where no plotting library is installed. For the driver's own disk."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        from matplotlib import pyplot
    except ImportError:
        return False
    n = points.count()
    rows, line = points.sample(False, min(1.0, most / max(n, 1)), 1).limit(most).collect(), sorted(curve.collect())
    shown = colours([r["entity"] for r in rows])
    for entity, colour in shown.items():
        own = [r for r in rows if r["entity"] == entity]
        pyplot.scatter([r["x_value"] for r in own], [r["y_value"] for r in own], c=colour, alpha=[r["display_alpha"] for r in own], label=entity)
    pyplot.plot([r[0] for r in line], [r[1] for r in line], "k--")
    pyplot.legend()
    pyplot.savefig(path)
    pyplot.close()
    return True


def report(summary: DataFrame, reasons: DataFrame, top: int = 12) -> str:
    """A short Markdown report of a summary row and the most frequent reasons."""
    row = summary.first()
    lines = ["# Summary", "", *[f"- {k}: {v}" for k, v in row.asDict().items()], "", "# Rejections", ""]
    lines += [f"- {r['reason']}: {r['n']}" for r in reasons.groupBy("reason").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "reason").limit(top).collect()]
    return "\n".join(lines) + "\n"
