"""Sources and sinks for question/response banks and feedback.

Banks are rows ``(id, pos, text)``. A writer never gathers a whole id: an id is
cut into blocks bounded in rows and bytes, and block folders are named by the
position their first text has (``first=0``, ``first=1000``, ...). A block is a
physical layout only: no document holds an id twice, and readers add ``first``
to the position inside the block, so what is read back does not depend on the
block size. Readers split files at records, never take a file as one value
(but for the reference's single JSON document).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.text import repair_text

BANK_SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType())])
GROUPED_LINE_SCHEMA = T.MapType(T.StringType(), T.ArrayType(T.StringType()))
GROUPED_DOC_SCHEMA = T.ArrayType(GROUPED_LINE_SCHEMA)
BLOCK_ROWS, BLOCK_BYTES, IDS_PER_FILE = 1_000, 16 << 20, 1_000
# --- fixed values (file layout of the reference's generated files) ---------
CSV_SEP = ";"
TRAINING_HEADER = 'version: "2.0" \n\nnlu:'
RESPONSE_HEADER = 'version: "2.0" \n\nintents:\n  - faq\n\nresponses:'
INTENT_PREFIX = "faq/"
RESPONSE_PREFIX = "utter_faq/"
# ---------------------------------------------------------------------------


def _bank_reader(spark: SparkSession, schema: T.StructType):
    return (spark.read.schema(schema).option("sep", CSV_SEP).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            # a missing cell is null, a quoted empty text is not: their marks must differ
            .option("nullValue", "\u0001").option("emptyValue", ""))


def _bank_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_reject = T.StructType([*schema.fields, T.StructField("_rejected", T.StringType())])
    return _bank_reader(spark, with_reject).option("columnNameOfCorruptRecord", "_rejected").csv(path)


def read_bank(spark: SparkSession, path: str, schema: T.StructType = BANK_SCHEMA) -> DataFrame:
    """A1: ``;``-delimited bank with header, optional quotes, UTF-8; texts may
    span lines and keep their blanks; a missing cell drops the row. Adds ``pos``:
    the row's 0-based place among the rows of its id. Rows that do not fit the
    schema are in :func:`bank_rejects`."""
    rows = _bank_rows(spark, path, schema).withColumn("_at", F.monotonically_increasing_id())
    good = rows.where("_rejected is null and id is not null and text is not null").drop("_rejected")
    return dense_positions(good, "id", "_at").drop("_at")


def bank_rejects(spark: SparkSession, path: str, schema: T.StructType = BANK_SCHEMA) -> DataFrame:
    """A1: the malformed records of a bank file, as they stand (column ``record``)."""
    rows = _bank_rows(spark, path, schema)
    # the whole row is selected first: Spark answers queries on the record column alone from the schema
    return rows.where("_rejected is not null or id is null").select(
        F.coalesce("_rejected", F.concat_ws(CSV_SEP, F.col("id").cast("string"), "text")).alias("record"))


def write_bank(df: DataFrame, path: str, id_col: str = "id", text: str = "text") -> None:
    """A1 writer: the same CSV layout (header, ``;``, quoted when needed; blanks
    and empty texts are kept)."""
    (df.select(F.col(id_col).cast("int").alias("id_question_pivot"), F.col(text).alias("reponse_prop"))
     .write.mode("overwrite")
     .option("sep", CSV_SEP).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""')
     .csv(path))


def dense_positions(df: DataFrame, id_col: str, order: str, out: str = "pos", width: int = 4096) -> DataFrame:
    """Add ``out``: the 0-based rank of each row inside its id by ``order`` (a long,
    a total order inside an id). Ranks are taken in chunks of ``width`` order
    values; the rows of earlier chunks come from a table of chunk counts, so a
    hot id is many tasks."""
    rows = df.withColumn("_chunk", F.floor(F.col(order) / width))
    counts = rows.groupBy(id_col, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(id_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(id_col, "_chunk", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy(id_col, "_chunk").orderBy(order)) - 1
    return (rows.withColumn("_at_chunk", at).join(before, [id_col, "_chunk"])
            .withColumn(out, F.col("_at_chunk") + F.col("_before")).drop("_chunk", "_at_chunk", "_before"))


def cut_blocks(df: DataFrame, id_col: str, pos: str, text: str, block_rows: int = BLOCK_ROWS,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``_n`` (0-based place in the id) and ``first`` (the ``_n`` at which the
    row's block starts). A block has at most ``block_rows`` rows, and ends once it
    holds ``block_bytes``."""
    rows = dense_positions(df, id_col, pos, "_n").withColumn("_part", F.floor(F.col("_n") / block_rows))
    upto = Window.partitionBy(id_col, "_part").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(F.octet_length(F.col(text))).over(upto), F.lit(0))
    rows = rows.withColumn("_cut", F.floor(filled / block_bytes))
    return rows.withColumn("first", F.min("_n").over(Window.partitionBy(id_col, "_part", "_cut")))


def write_grouped_json(df: DataFrame, path: str, id_col: str = "id", pos: str = "pos", text: str = "text",
                       block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> None:
    """A3: group texts by id into ``{"<id>": [text, ...]}`` lines (texts ordered by
    ``pos``), one line per block, blocks in folders ``first=<place of its first text>``."""
    b = cut_blocks(df, id_col, pos, text, block_rows, block_bytes)
    grouped = b.groupBy(id_col, "first").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_n").alias("p"), F.col(text).alias("t")))).alias("_items"))
    line = F.to_json(F.create_map(F.col(id_col).cast("string"), F.transform("_items", lambda x: x["t"])))
    grouped.select("first", line.alias("value")).write.mode("overwrite").partitionBy("first").text(path)


def _first(df: DataFrame) -> Column:
    """The block's first place; files outside block folders start at 0."""
    return F.col("first").cast("bigint") if "first" in df.columns else F.lit(0).cast("bigint")


def read_grouped_json(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """A2: grouped bank to rows ``(id, pos, text)``, ``pos`` from 1.

    The default reads what ``write_grouped_json`` writes: one map per line,
    split across tasks. ``document=True`` reads the reference's single JSON
    array of maps (one document per file)."""
    if document:
        raw = spark.read.text(path, wholetext=True)
        maps = raw.select(F.explode(F.from_json("value", GROUPED_DOC_SCHEMA)).alias("m"), _first(raw).alias("first"))
    else:
        raw = spark.read.text(path)
        maps = raw.select(F.from_json("value", GROUPED_LINE_SCHEMA).alias("m"), _first(raw).alias("first"))
    entries = maps.select("first", F.explode("m").alias("id", "texts"))
    return entries.select("id", "first", F.posexplode("texts").alias("p", "text")).select(
        "id", (F.col("first") + F.col("p") + 1).alias("pos"), "text")


def _write_documents(blocks: DataFrame, path: str, id_col: str, header: str) -> None:
    """One document per (first, part) folder: the header, then its blocks by id.
    ``part`` spreads the ids over files of about ``IDS_PER_FILE`` ids."""
    n = blocks.select(id_col).distinct().count()
    part = F.pmod(F.xxhash64(id_col), F.lit(max(1, -(-n // IDS_PER_FILE)))).cast("int")
    body = blocks.select("first", part.alias("part"), F.lit(1).alias("kind"), F.col(id_col).alias("_id"), "value")
    heads = body.select("first", "part").distinct().select(
        "first", "part", F.lit(0).alias("kind"), F.lit(None).cast(body.schema["_id"].dataType).alias("_id"),
        F.lit(header).alias("value"))
    (heads.unionByName(body).repartition("first", "part").sortWithinPartitions("first", "part", "kind", "_id")
     .select("first", "part", "value").write.mode("overwrite").partitionBy("first", "part").text(path))


def _block_text(lines: DataFrame, id_col: str, head: Column) -> DataFrame:
    """(id, first, value): a block's heading and its lines as one record."""
    blocks = lines.groupBy(id_col, "first").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_n").alias("p"), "line"))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: x["line"]), "\n")
    return blocks.select(id_col, "first", F.concat(head, body).alias("value"))


def emit_training_blocks(df: DataFrame, path: str, id_col: str = "id", pos: str = "pos", text: str = "text",
                         block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> None:
    """A4: per id a heading ``- intent: faq/N``, ``  examples: |`` and one
    ``    - text`` line per example, repaired with B1 ``full``. Line breaks inside a
    text become spaces so one example stays one line."""
    b = cut_blocks(df, id_col, pos, text, block_rows, block_bytes)
    clean = F.regexp_replace(repair_text(F.col(text), "full"), r"[\r\n]+", " ")
    lines = b.select(id_col, "first", "_n", F.concat(F.lit("    - "), clean).alias("line"))
    head = F.concat(F.lit("- intent: " + INTENT_PREFIX), F.col(id_col).cast("string"), F.lit("\n  examples: |\n"))
    _write_documents(_block_text(lines, id_col, head), path, id_col, TRAINING_HEADER)


def emit_response_blocks(df: DataFrame, path: str, id_col: str = "id", pos: str = "pos", text: str = "text",
                         block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> None:
    """A5: per id ``  utter_faq/N:`` and ``    - text: "..."`` per variant (quoted as
    the reference writes it, repaired with B1 ``full``; texts may span lines)."""
    b = cut_blocks(df, id_col, pos, text, block_rows, block_bytes)
    quoted = F.concat(F.lit('    - text: "'), repair_text(F.col(text), "full"), F.lit('"'))
    lines = b.select(id_col, "first", "_n", quoted.alias("line"))
    head = F.concat(F.lit("  " + RESPONSE_PREFIX), F.col(id_col).cast("string"), F.lit(":\n"))
    _write_documents(_block_text(lines, id_col, head), path, id_col, RESPONSE_HEADER)


def _records(spark: SparkSession, path: str, heading: str) -> DataFrame:
    """A block file split at the headings: (first, value), the file header left out."""
    raw = spark.read.option("lineSep", "\n" + heading).text(path)
    return raw.select(_first(raw).alias("first"), "value").where(~F.col("value").startswith("version:"))


def read_training_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Block text back to ``(intent, pos, text)``, ``pos`` from 1: one record per
    heading, each ``    - `` line an example, only the bullet dropped. A line ends at
    ``\\n`` and nothing else."""
    r = _records(spark, path, "- intent: ")
    parsed = r.select("first", F.regexp_extract("value", r"^([^\n]*)", 1).alias("intent"),
                      F.regexp_extract_all("value", F.lit(r"\n    - ([^\n]*)"), 1).alias("ex"))
    return parsed.select("intent", "first", F.posexplode("ex").alias("p", "text")).select(
        "intent", (F.col("first") + F.col("p") + 1).alias("pos"), "text")


def read_response_blocks(spark: SparkSession, path: str) -> DataFrame:
    """A5 reader: response file back to ``(response, pos, text)``, ``pos`` from 1. Texts
    may span lines; the next variant starts at ``"`` and a new ``    - text: "`` line."""
    r = _records(spark, path, "  " + RESPONSE_PREFIX)
    body = F.regexp_replace("value", r'^[^\n]*\n    - text: "', "")
    texts = F.split(F.regexp_replace(body, r'"\n?\z', ""), r'"\n    - text: "', -1)
    # taken apart before the texts become rows: the name is read once per record
    parsed = r.select(F.concat(F.lit(RESPONSE_PREFIX), F.regexp_extract("value", r"^([^:\n]*):", 1)).alias("response"),
                      "first", texts.alias("texts"))
    return parsed.select("response", "first", F.posexplode("texts").alias("p", "text")).select(
        "response", (F.col("first") + F.col("p") + 1).alias("pos"), "text")


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def append_feedback(df: DataFrame, path: str | None = None, partition_col: str | None = None,
                    fmt: str = "parquet", options: dict | None = None, key: str | None = None) -> bool:
    """Append rated interactions, once per ``key``; true if this call's rows count.

    A table of files is a folder of appends. An append is written to a folder of its own under
    ``path/data`` and counts once its commit record ``path/commits/<hash of key>`` exists, which
    names that folder. The record is created only if there is none: of appends with one key, one
    at a time or several at once, the first to finish wins, and what a failed or repeated one
    has written is never read. Without ``key`` every call is an append of its own.

    Any Spark sink without a path works as it does by itself (for a database, ``fmt="jdbc"`` with
    url/dbtable options); it takes no key. The stream forms (J4) key their writes by batch id."""
    w = df.write.format(fmt).options(**(options or {}))
    if partition_col:
        w = w.partitionBy(partition_col)
    if path is None:
        if key is not None:
            raise ValueError("a key needs a table of files")
        w.mode("append").save()
        return True
    spark, own = df.sparkSession, uuid.uuid4().hex
    name = hashlib.sha256(key.encode()).hexdigest() if key is not None else own
    record, fs = _folder(spark, f"{path.rstrip('/')}/commits/{name}")
    if fs.exists(record):
        return False
    w.mode("errorifexists").save(f"{path.rstrip('/')}/data/append_id={own}")
    # the record appears whole: written aside, then given its name, which fails if there is one
    draft, _ = _folder(spark, f"{path.rstrip('/')}/drafts/{own}")
    out = fs.create(draft, False)
    out.write(own.encode())
    out.close()
    fs.mkdirs(record.getParent())
    return not fs.exists(record) and fs.rename(draft, record) and _record(fs, record) == own


def _record(fs, at) -> str:
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_feedback(spark: SparkSession, path: str | None = None, columns: Sequence[str] | None = None,
                  fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Full read-back of the feedback table (any Spark source); of a table of files, the
    committed appends. The driver reads one short record per append."""
    r = spark.read.format(fmt).options(**(options or {}))
    if path is None:
        df = r.load()
    else:
        commits, fs = _folder(spark, f"{path.rstrip('/')}/commits")
        names = sorted(_record(fs, x.getPath()) for x in fs.listStatus(commits)) if fs.exists(commits) else []
        if not names:
            raise FileNotFoundError(f"no committed append in {path}")
        data = f"{path.rstrip('/')}/data"
        df = r.option("basePath", data).load([f"{data}/append_id={n}" for n in names]).drop("append_id")
    return df.select(*columns) if columns else df


def write_item_matrix(df: DataFrame, path: str) -> None:
    """A8 writer: wide 0/1 matrix as ``;`` CSV with header."""
    df.write.mode("overwrite").option("sep", CSV_SEP).option("header", True).csv(path)


def read_item_matrix(spark: SparkSession, path: str, key: str = "role",
                     items: Sequence[str] | None = None) -> DataFrame:
    """Wide 0/1 matrix to ``(role, item)`` rows where the flag is set.
    The schema is read from the header line only (no data pass)."""
    reader = spark.read.option("sep", CSV_SEP).option("header", True)
    if items is None:
        header = spark.read.text(path).limit(1).collect()[0][0]
        items = [c for c in header.split(CSV_SEP) if c != key]
    schema = ", ".join([f"`{key}` string"] + [f"`{c}` int" for c in items])
    wide = reader.schema(schema).csv(path)
    long = wide.unpivot(key, list(items), "item", "flag")
    return long.filter(F.col("flag") != 0).select(key, "item")
