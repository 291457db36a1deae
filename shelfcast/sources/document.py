"""The hand-off as JSON documents: one object with the arrays of ``store.SYNC_TABLES``.

A document is laid out with an indent of two, so an array's rows open and close
at a line of four spaces and a brace. A JSON string holds no raw line break,
hence the break, the four spaces and the closing brace end a row and nothing
else: the text reader cuts there, a document is split over many tasks, and no
task holds more than one row at a time. There is no limit on a document's size.

A row's array is named by the nearest array opening before it in its file; the
openings, at most one an array and document, are joined back by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources import store

ROW_END = "\n    }"
ROW_START = "\n    {"
ROWS_PER_DOCUMENT = 100_000
BROADCAST_DOCUMENTS = 20_000     # their openings are some MB


def _is_row() -> Column:
    return F.instr("value", ROW_START) > 0


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value): the text up to each row's end, ``at`` ascending along the file."""
    # within a block the ids ascend; they are compared with those of the same block only
    return (spark.read.option("lineSep", ROW_END).option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("at"),
                    "value"))


def _check(pieces: DataFrame) -> None:
    """Every document must end behind its last row; another layout, or a cut document, is refused."""
    rest = F.trim(F.translate("value", "\n\r\t", "   "))
    inner = F.substring(rest, F.lit(2), F.length(rest))
    end = ~_is_row() & rest.endswith("}") & (F.instr(inner, "{") == 0)
    # judged before the aggregate, which sorts: its rows are positions and marks, not the text
    marks = pieces.select("file", "at", _is_row().alias("row"), end.alias("end"))
    faults = (marks.groupBy("file").agg(F.count_if("end").alias("ends"), F.count_if(~F.col("row") & ~F.col("end")).alias("strange"),
                                        (F.max("at") == F.max(F.when(F.col("end"), F.col("at")))).alias("last"))
              .filter((F.col("ends") != 1) | (F.col("strange") > 0) | ~F.col("last")))
    bad = [r["file"] for r in faults.select("file").limit(5).collect()]
    if bad:
        raise ValueError(f"documents that are cut off or not laid out with an indent of two: {', '.join(bad)}")


def read_documents(spark: SparkSession, path: str, work_dir: str) -> dict[str, DataFrame]:
    """The hand-off tables of one document, or of a folder of them, with their fixed schemas.

    Pieces are written once under ``work_dir`` (shared folder): the arrays are
    read from there, and positions stay those of one scan. An array that a
    document does not name is empty there; a row that does not parse, an empty
    file and a document of another layout fail the load.
    """
    files = store.data_files(spark, path)
    empty = [name for name, size, _ in files if size == 0]
    if empty:
        raise ValueError(f"empty documents: {', '.join(empty[:5])}")
    _pieces(spark, path).write.mode("overwrite").parquet(f"{work_dir}/pieces")
    pieces = spark.read.parquet(f"{work_dir}/pieces")
    _check(pieces)
    rows = pieces.filter(_is_row()).select(
        "file", "at", F.regexp_extract("value", r'\n  "([^"]+)" ?: \[\n    \{', 1).alias("opens"),
        F.concat(F.lit("{"), F.substring("value", F.instr("value", ROW_START) + len(ROW_START), F.length("value")), F.lit("}")).alias("row"))
    openings = (rows.filter("opens <> ''").groupBy("file")
                .agg(F.array_sort(F.collect_list(F.struct("at", "opens"))).alias("openings")))
    if len(files) <= BROADCAST_DOCUMENTS:              # a row or two of names a document: the rows need not move to meet them
        openings = F.broadcast(openings)
    own = F.element_at(F.filter("openings", lambda o: o["at"] <= F.col("at")), -1)["opens"]
    # each array is kept by itself, so that a table reads its own rows and not those of all five
    rows.join(openings, "file").select(own.alias("array"), "row").write.mode("overwrite").partitionBy("array").parquet(f"{work_dir}/rows")
    named = spark.read.schema("row STRING, array STRING").parquet(f"{work_dir}/rows")
    return {name: named.filter(F.col("array") == name)
            .select(F.from_json("row", store.table_schema(table), {"mode": "FAILFAST"}).alias("r")).select("r.*")
            for name, table in store.SYNC_TABLES.items()}


def write_documents(tables: dict[str, DataFrame], out_dir: str, rows_per_document: int = ROWS_PER_DOCUMENT,
                    compression: str = "none") -> None:
    """The hand-off as a folder of documents of about ``rows_per_document`` rows, one file each (packed with ``compression``)."""
    parts = []
    for number, name in enumerate(store.SYNC_TABLES):
        fields = F.to_json(F.struct("*"))
        parts.append(tables[name].select(F.lit(number).alias("number"), F.lit(name).alias("name"),
                                         F.substring(fields, F.lit(2), F.length(fields) - 2).alias("fields")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    documents = max(1, -(-rows.count() // rows_per_document))
    dealt = rows.withColumn("document", F.pmod(F.xxhash64("name", "fields"), F.lit(documents)))
    along = Window.partitionBy("document").orderBy("number", "fields")
    before, after = F.lag("name").over(along), F.lead("name").over(along)
    opening = F.concat(F.lit('  "'), F.col("name"), F.lit('": [\n'))
    lead_in = F.when(before.isNull(), F.concat(F.lit("{\n"), opening)).when(before != F.col("name"), opening).otherwise("")
    ending = F.when(after.isNull(), F.lit("\n  ]\n}")).when(after != F.col("name"), F.lit("\n  ],")).otherwise(",")
    text = F.concat(lead_in, F.lit("    {\n      "), "fields", F.lit(ROW_END), ending)
    dealt.select("document", text.alias("value")).write.mode("overwrite").partitionBy("document").option("compression", compression).text(out_dir)
