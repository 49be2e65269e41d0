"""Writers by format, projections of records for publishing, compliance, manifests, metrics text."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..functions.nested import list_to_json, list_to_text
from ..operators.common import saved


def flat(df: DataFrame, as_json: bool = True) -> DataFrame:
    """Lists as JSON text, or joined by bars; maps and structs as JSON."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, ArrayType):
            out[f.name] = list_to_json(F.col(f.name)) if as_json else list_to_text(F.col(f.name))
        elif isinstance(f.dataType, (MapType, StructType)):
            out[f.name] = F.to_json(f.name)
    return df.withColumns(out) if out else df


def write(df: DataFrame, path: str, fmt: str, drop: Sequence[str] = (), partition_by: Sequence[str] = (), compression: str = "snappy", sep: str = ",") -> str:
    """Write as parquet, jsonl, json (one array) or csv; the path is returned."""
    df = df.drop(*drop)
    if fmt == "parquet":
        flat(df).write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)
    elif fmt == "jsonl":
        df.write.mode("overwrite").option("ignoreNullFields", False).partitionBy(*partition_by).json(path)
    elif fmt == "csv":
        flat(df, as_json=False).write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)
    elif fmt == "json":
        # each file is an array of its own: a reader of multi-line JSON takes all of them together
        row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
        lines = df.select(row)

        def arrays(batches):
            import pyarrow as pa

            first = True
            for b in batches:
                for text in b.column(0).to_pylist():
                    yield pa.record_batch([pa.array([("[" if first else ",") + text])], ["value"])
                    first = False
            if not first:
                yield pa.record_batch([pa.array(["]"])], ["value"])

        lines.mapInArrow(arrays, "value string").write.mode("overwrite").text(path)
    else:
        raise ValueError(f"no writer for {fmt}")
    return path


def write_all(df: DataFrame, folder: str, name: str, formats: Sequence[str], **options) -> dict[str, str]:
    """The same rows in several formats: {format: path}. The rows are computed and saved once."""
    df = saved(df, "rows")
    first = write(df, f"{folder}/{name}.{formats[0]}", formats[0], **options)
    return {formats[0]: first} | {f: write(df, f"{folder}/{name}.{f}", f, **options) for f in formats[1:]}


# Fields that may be published, internal ones, those of the wider form, and names to change.
PUBLIC = [
    "uuid", "persona", "professional_persona", "sports_persona", "arts_persona", "travel_persona", "culinary_persona",
    "cultural_background", "skills_and_expertise", "skills_and_expertise_list", "hobbies_and_interests", "hobbies_and_interests_list",
    "career_goals_and_ambitions", "sex", "age", "marital_status", "education_level", "occupation", "municipality", "state", "country",
]
INTERNAL = [
    "ocean_scores", "ocean_raw_scores", "behavioral_cues", "constraints", "validation", "passed_validation", "rewrite_count",
    "ocean_deviation_score", "repair_history", "prompt_hash", "trace_id", "generation_metadata",
]
EXTRA = ["locality", "ethnicity", "religion", "residence_type", "age_group", "ocean_profile"]
RENAMED = {"district": "municipality", "region": "state", "city": "locality"}
TRAIT_FIELDS = [f"ocean_{t}" for t in ("openness", "conscientiousness", "extraversion", "agreeableness", "neuroticism")]


def _traits(df: DataFrame) -> list[Column]:
    if "ocean_profile" in df.columns:
        return [F.col("ocean_profile")]
    if not set(TRAIT_FIELDS) <= set(df.columns):
        return []
    complete = F.col(TRAIT_FIELDS[0]).isNotNull()
    for f in TRAIT_FIELDS[1:]:
        complete = complete & F.col(f).isNotNull()
    return [F.when(complete, F.struct(*TRAIT_FIELDS)).alias("ocean_profile")]


def public(df: DataFrame, source: Mapping[str, str], wide: bool = False) -> DataFrame:
    """The fields that may be published, in the wide form with a trait struct if all traits are there, and where it comes from."""
    df = df.withColumnsRenamed({a: b for a, b in RENAMED.items() if b not in df.columns})
    names = [c for c in PUBLIC + (EXTRA if wide else []) if c in df.columns and c not in INTERNAL and c != "ocean_profile"]
    return df.select(*names, *(_traits(df) if wide else []), F.struct(*[F.lit(v).alias(k) for k, v in source.items()]).alias("_source"))


def internal(df: DataFrame, metadata: Mapping[str, str]) -> DataFrame:
    return df.withColumn("_export_metadata", F.struct(*[F.lit(v).alias(k) for k, v in metadata.items()]))


def ordered(df: DataFrame, fields: Sequence[str], renamed: Mapping[str, str] = RENAMED) -> DataFrame:
    """The fields in order under their new names, as text; missing and null ones are empty."""
    have = set(df.columns)
    return df.select([(F.coalesce(F.col(f).cast("string"), F.lit("")) if f in have else F.lit("")).alias(renamed.get(f, f)) for f in fields])


def compliance(df: DataFrame, required: Sequence[str], forbidden: Sequence[str], rows: int = 5) -> DataFrame:
    """A look at the first rows: which required keys each lacks, and which forbidden ones it has."""
    keys = F.json_object_keys(F.to_json(F.struct("*")))
    got = df.limit(rows).select(keys.alias("k"))
    return got.select(F.array_except(F.array(*map(F.lit, required)), "k").alias("missing"), F.array_intersect(F.array(*map(F.lit, forbidden)), "k").alias("forbidden"))


def statistics_markdown(shares: DataFrame, targets: DataFrame, title: str = "Distribution") -> str:
    """A table of a report: (field, value, share) against (field, value, p)."""
    both = shares.join(targets.select("field", "value", "p"), ["field", "value"], "full_outer").orderBy("field", F.desc("share"), "value")
    lines = [f"# {title}", "", "| field | value | actual | target | gap |", "|---|---|---|---|---|"]
    for r in both.toLocalIterator():
        a, p = r["share"] or 0.0, r["p"]
        lines.append(f"| {r['field']} | {r['value']} | {a:.2%} | " + (f"{p:.2%} | {a - p:+.2%} |" if p is not None else "- | - |"))
    return "\n".join(lines) + "\n"


def config_hash(config: Mapping) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def manifest(path: str, config: Mapping, seed: int, provenance: Mapping[str, str], gates: Mapping | None = None, n: int = 0) -> dict:
    """Write what a run was made with beside its data."""
    now = dt.datetime.now(dt.UTC)
    body = {"run_id": now.strftime("%Y%m%d_%H%M%S"), "created": now.isoformat(), "config": dict(config), "config_sha256": config_hash(config), "seed": seed, "provenance": dict(provenance), "gates": dict(gates or {}), "rows": n}
    Path(path).write_text(json.dumps(body, indent=2, sort_keys=True, ensure_ascii=False), encoding="utf-8")
    return body


def load_manifest(path: str) -> dict:
    body = json.loads(Path(path).read_text(encoding="utf-8"))
    if body["config_sha256"] != config_hash(body["config"]):
        raise ValueError(f"the configuration in {path} was changed after it was written")
    return body


def metrics_text(metrics: DataFrame) -> DataFrame:
    """(line) of metrics (name, value, tags map) in the exposition format of a metrics scraper."""
    tags = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit('="'), F.replace(F.replace(F.replace(e["value"], F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))), ",")
    labels = F.when(F.size("tags") > 0, F.concat(F.lit("{"), tags, F.lit("}"))).otherwise("")
    return metrics.select(F.concat(F.regexp_replace("name", "[^a-zA-Z0-9_:]", "_"), labels, F.lit(" "), F.col("value").cast("string")).alias("line"))


def json_to_parquet(spark: SparkSession, source: str, target: str, schema: str) -> str:
    """Rows saved as JSON Lines as Parquet; lines that cannot be read are left out."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(source)
    return write(rows, target, "parquet")
