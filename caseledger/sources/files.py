"""Tables at the boundary: all-string CSV, JSON records, rule files, archives; fixed column order on the way out."""

from __future__ import annotations

import io
import json
import tempfile
import uuid
import zipfile
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseledger.functions.text import control_safe


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder of the session (``spark.checkpoint.dir``); local sessions may lack one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local"):
        base = spark.sparkContext.getCheckpointDir()
        if base is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="caseledger-"))
            base = spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def discard(spark: SparkSession, path: str) -> None:
    """Removes what a job has written below the shared folder for itself and read for the last time."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "UTF-8", missing_ok: bool = False, multi_line: bool = True) -> DataFrame:
    """Header, RFC 4180 quotes, embedded newlines, every cell a string; blank cells come back as "".

    One task reads a whole file, since any cell may hold a newline. Where none does, ``multi_line=False`` lets large files
    be split.

    With ``missing_ok`` an absent path is an empty table of the same schema."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], strings(columns))
    raw = spark.read.schema(strings(columns)).csv(path, header=True, multiLine=multi_line, quote='"', escape='"', encoding=encoding, enforceSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return raw.fillna("")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """Layered scan: the first of several places that has the table."""
    return next((p for p in paths if exists(spark, p)), None)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Fixed column order; absent columns are blank, extra ones left out; LF line ends."""
    cols = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*cols).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=True, lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def rules(spark: SparkSession, rows: Sequence[Mapping], required: Sequence[str]) -> DataFrame:
    """A small ordered rule table; a rule without a required key is an error that names it."""
    for i, r in enumerate(rows):
        if missing := set(required) - r.keys():
            raise KeyError(f"rule {i} lacks {sorted(missing)}")
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([(i, *[None if r.get(n) is None else str(r[n]) for n in names]) for i, r in enumerate(rows)], "ord int, " + ", ".join(f"`{n}` string" for n in names))


def load_yaml(text: str, required: Sequence[str] = ()) -> dict:
    import yaml

    got = yaml.safe_load(text)
    if missing := set(required) - set(got):
        raise KeyError(f"missing {sorted(missing)}")
    return got


def zip_members(files: DataFrame, preferred: str) -> DataFrame:
    """(path, member, text, error) of binaryFile rows: the preferred member, else the sole .txt, else an error."""

    def run(batches):
        for b in batches:
            out = []
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        names = z.namelist()
                        texts = [n for n in names if n.lower().endswith(".txt")]
                        pick = preferred if preferred in names else texts[0] if len(texts) == 1 else None
                        out.append({"path": path, "member": pick, "text": z.read(pick).decode("cp1252", "replace") if pick else None, "error": None if pick else "no single member"})
                except zipfile.BadZipFile:
                    out.append({"path": path, "member": None, "text": None, "error": "not an archive"})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, pa.string()) for n in ("path", "member", "text", "error")]))

    return files.select("path", "content").mapInArrow(run, "path string, member string, text string, error string")


def typed(c: Column, kind: str) -> Column:
    """Strict cast for exports: blank is null, a bad value raises (ANSI)."""
    bare = F.nullif(F.trim(c), F.lit(""))
    return {"int": bare.cast("int"), "date": bare.cast("date"), "double": bare.cast("double"), "text": F.nullif(control_safe(c), F.lit(""))}[kind]


def manifest_text(values: Mapping) -> str:
    return json.dumps(values, sort_keys=True, indent=2) + "\n"


def markdown(df: DataFrame, limit: int = 200) -> str:
    """A report table of a small, already aggregated result. More rows than the report's limit are an error, never left out."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report table takes {limit} rows at most")
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    return head + "".join("\n| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows) + "\n"
