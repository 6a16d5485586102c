"""CSV and JSON feeds, and the CSV export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.functions.text import present
from leadloom.operators.query import export_rows
from leadloom.schema import SEED_HEADERS, SUBMISSION_SCHEMA
from leadloom.sources.scratch import written

# a file whose header differs from the others' fails the job instead of shifting columns
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "enforceSchema": False}
# tables of files and rows are summed in so many parts before their sums meet
_PARTS = 64

# submission field -> header in a CSV of leads; the others are absent there
_SUBMISSION_HEADERS = {
    "email": "Email",
    "phone": "Phone Number",
    "company": "Company Name",
    "country": "Country/Region",
    "message": "Notes",
    "submitted_at": "Create Date",
}


def _placed(df: DataFrame, columns: list) -> DataFrame:
    """``columns`` with the file, the split and the place in it.

    Spark rows have no order, but within one split of a file the row id grows
    with the place.
    """
    return df.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """``placed`` with ``seq``: 1, 2, ... by file name, then place in the file."""
    split = ["_file", "_start"]
    counts = placed.groupBy(*split).agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy(*split).orderBy("_row"))
    numbered = placed.withColumn("_place", place).join(running_totals(counts, split, "_n"), split)
    return numbered.withColumn("seq", F.col("_before") + F.col("_place")).drop(*split, "_row", "_before", "_place")


def running_totals(counts: DataFrame, order: list[str], size: str) -> DataFrame:
    """``counts`` without ``size``, with ``_before``: the sum of ``size`` over all rows before, by ``order``.

    Rows are ranged into ``_PARTS`` parts; only the sums of the parts meet in one
    task, so there may be as many rows as there are files or records.
    """
    counts = counts.select(*order, size)
    ranged = written(counts.repartitionByRange(_PARTS, *order).withColumn("_part", F.spark_partition_id()), "totals")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_part").agg(F.sum(size).alias("_sum"))
    # at most _PARTS rows
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(above), F.lit(0)).alias("_offset"))
    within = F.coalesce(F.sum(size).over(inside), F.lit(0))
    totals = ranged.withColumn("_within", within).join(F.broadcast(offsets), "_part")
    return totals.select(*order, (F.col("_offset") + F.col("_within")).alias("_before"))


def _in_file_order(df: DataFrame, columns: list) -> DataFrame:
    return _numbered(_placed(df, columns))


def csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files at ``path`` by their header line.

    Reads lines, not whole files, in as many tasks as there are splits. Raises
    unless every file is named ``.csv`` and is UTF-8: Spark's CSV reader would
    turn bad bytes into replacement characters without a word.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    files = lines.groupBy("file").agg(
        F.min_by("value", "place").alias("header"), F.count_if(~F.is_valid_utf8("value")).alias("broken")
    )
    files = written(files, "headers")
    bad = files.where((F.col("broken") > 0) | ~F.lower("file").endswith(".csv")).select("file").limit(5).collect()
    if bad:
        raise ValueError("not a CSV file in UTF-8: " + ", ".join(r["file"] for r in bad))
    found: dict[str, list[str]] = {}
    for r in files.select("file", "header").collect():
        found.setdefault(r["header"].removeprefix(chr(0xFEFF)).rstrip("\r"), []).append(r["file"])
    return found


def _read_by_header(spark: SparkSession, path: str, columns) -> DataFrame:
    """Rows of all files, each read by its own header; ``columns`` gets the header names of a group of files."""
    groups = csv_headers(spark, path)
    parts = []
    for header in sorted(groups):
        rows = spark.read.options(**_CSV).csv(groups[header])
        parts.append(_placed(rows, columns(rows.columns)))
    if not parts:
        raise ValueError(f"no CSV files at {path}")
    return _numbered(reduce(DataFrame.unionByName, parts))


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed records as text in the lead columns, with ``seq`` by place in the file.

    Files are UTF-8 with or without a byte order mark, have a header row, and may
    have quoted fields with line breaks. Columns go by each file's own header, in
    any order; one that is missing is an error.
    """

    def columns(given: list[str]) -> list:
        missing = [h for h in SEED_HEADERS if h not in given]
        if missing:
            raise ValueError("missing columns: " + ", ".join(missing))
        return [F.col(f"`{header}`").alias(c) for header, c in SEED_HEADERS.items()]

    return _read_by_header(spark, path, columns)


def read_submission_csv(spark: SparkSession, path: str) -> DataFrame:
    """Submissions from CSVs of leads, with ``seq``; headers that a file lacks give null."""

    def columns(given: list[str]) -> list:
        def field(header: str):
            return F.col(f"`{header}`") if header in given else F.lit(None).cast("string")

        parts = F.concat_ws(" ", present(field("First Name")), present(field("Last Name")))
        fields = {f: field(h) for f, h in _SUBMISSION_HEADERS.items()}
        fields["name"] = F.coalesce(present(field("Full Name")), parts)
        return [fields.get(f, F.lit(None).cast("string")).alias(f) for f in SUBMISSION_SCHEMA.names]

    return _read_by_header(spark, path, columns)


def _items(files: DataFrame) -> DataFrame:
    items = F.from_json("value", T.ArrayType(SUBMISSION_SCHEMA), {"mode": "FAILFAST"})
    return files.select("_file", F.posexplode(items).alias("_pos", "_item")).select("_file", "_pos", "_item.*")


def _first_char(text):
    return F.left(F.ltrim(F.translate(text, "\n\r\t", "   ")), F.lit(1))


def _read_item(items: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the submission fields and ``error`` of the JSON texts in ``_text``.

    An item is an object whose known fields are texts, numbers, truth values or
    null. ``error`` says what is wrong with any other, whose fields are then null.
    """
    parsed = items.withColumn("_variant", F.try_parse_json("_text"))
    is_object = _first_char(F.col("_text")) == "{"
    kinds = {f: F.schema_of_variant(F.try_variant_get("_variant", f"$.{f}", "variant")) for f in SUBMISSION_SCHEMA.names}
    nested = [F.when(k.startswith("OBJECT") | k.startswith("ARRAY"), F.lit(f"{f} is not a text")) for f, k in kinds.items()]
    error = (
        F.when(F.col("_variant").isNull(), F.lit("malformed JSON"))
        .when(~is_object, F.lit("not an object"))
        .otherwise(F.nullif(F.array_join(F.array_compact(F.array(*nested)), ", "), F.lit("")))
    )
    parsed = parsed.withColumn("error", error)
    good = F.when(F.col("error").isNull(), F.col("_text"))
    parsed = parsed.withColumn("_item", F.from_json(good, SUBMISSION_SCHEMA, {"mode": "PERMISSIVE"}))
    return parsed.select(*keep, "_item.*", "error")


def _kept_items(files: DataFrame) -> DataFrame:
    """As ``_items``, with ``error``; a file that is no JSON array or object is one item with an error."""
    texts = F.from_json("value", T.ArrayType(T.StringType()), {"mode": "PERMISSIVE"})
    several = F.when(_first_char(F.col("value")) == "[", texts)
    whole = F.array(F.col("value"))
    items = files.select("_file", F.posexplode(F.coalesce(several, whole)).alias("_pos", "_text"))
    # a null in an array is an item too
    items = items.withColumn("_text", F.coalesce("_text", F.lit("null")))
    return _read_item(items, ["_file", "_pos"])


def _on_error(value: str) -> bool:
    if value not in ("fail", "keep"):
        raise ValueError("on_error must be fail or keep")
    return value == "keep"


def read_submission_json(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Submissions from JSON files, each one object or one array of objects.

    ``seq`` counts by file name and then place in the array; unknown fields are
    ignored and a number becomes text. Malformed JSON fails the job; with
    ``on_error="keep"`` an item that is no object, or has an object or array where a
    text belongs, stays as a row with the reason in ``error`` and all else null, and
    so does a file that is no JSON as a whole; fractions then take their shortest
    form. A file is one request and is parsed
    by one task; for bulk loads use ``read_submission_lines``.
    """
    files = spark.read.text(path, wholetext=True)
    files = files.select("value", F.col("_metadata.file_path").alias("_file"))
    # counted and numbered from there; the files are read and parsed once
    return number_items(written((_kept_items if _on_error(on_error) else _items)(files), "items"))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The text of files up to every closing brace, with its place and the braces that it opens and closes.

    ``inside`` says that the chunk begins inside a JSON string, ``depth`` how many
    braces and brackets are open after it. Both are sums over all chunks before:
    within a split of a file by a window over numbers, across splits by totals.
    """
    placed = _placed(spark.read.option("lineSep", "}").text(path), ["value"])
    plain = F.regexp_replace("value", r"\\.", "")

    def change(text) -> Column:
        # strings fall away; one that does not end in the chunk has the closing brace in it
        bare = F.regexp_replace(text, '"[^"]*("|$)', "")
        opened = F.char_length(F.regexp_replace(bare, r"[^{\[]", ""))
        closed = F.char_length(F.regexp_replace(bare, r"[^}\]]", ""))
        whole = F.char_length(F.regexp_replace(text, '[^"]', "")) % 2 == 0
        return opened - closed - F.when(whole, 1).otherwise(0)

    numbers = placed.withColumn("_plain", plain).select(
        "_file", "_start", "_row",
        (F.char_length(F.regexp_replace("_plain", '[^"]', "")) % 2).cast("long").alias("_quotes"),
        change(F.col("_plain")).cast("long").alias("_outer"),
        # a chunk that begins inside a string begins with its rest
        change(F.concat(F.lit('"'), F.col("_plain"))).cast("long").alias("_inner"),
    )
    numbers = written(numbers, "chunks")
    inside = _sum_before(numbers, "_quotes").withColumn("_inside", F.col("_sum") % 2 == 1).drop("_sum")
    inside = written(inside.withColumn("_change", F.when(F.col("_inside"), F.col("_inner")).otherwise(F.col("_outer"))), "chunks")
    depth = _sum_before(inside, "_change").withColumn("_depth", F.col("_sum") + F.col("_change")).drop("_sum")
    return placed.join(depth.select("_file", "_start", "_row", "_inside", "_depth", "_quotes"), ["_file", "_start", "_row"])


def _sum_before(rows: DataFrame, size: str) -> DataFrame:
    """``rows`` with ``_sum``, the sum of ``size`` over all rows before in their file."""
    split = ["_file", "_start"]
    totals = rows.groupBy(*split).agg(F.sum(size).alias("_total"))
    # splits of one file only: there are as many as it has blocks
    order = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*split, F.coalesce(F.sum("_total").over(order), F.lit(0)).alias("_above"))
    within = Window.partitionBy(*split).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0))).join(totals, split)
    return summed.withColumn("_sum", F.col("_above") + F.col("_within")).drop("_above", "_within")


def read_submission_arrays(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Submissions from JSON files, each one array of objects, however large.

    Files are read in splits by many tasks, as text up to every closing brace; what
    belongs to one object is found by sums and put together by a shuffle, so no task
    holds an array. ``seq`` counts by file name and then place in the array. What is
    no object between objects, or one that cannot be read, fails the job; with
    ``on_error="keep"`` it stays as a row with ``error``.
    """
    keep = _on_error(on_error)
    chunks = written(_chunks(spark, path), "chunks")
    # an object is whole where one bracket is open after its last brace, outside of any string
    ends = chunks.withColumn("_end", ((F.col("_depth") == 1) & (F.col("_inside").cast("long") + F.col("_quotes")).isin(0, 2)).cast("long"))
    numbered = _sum_before(ends, "_end").withColumnRenamed("_sum", "_pos")
    pieces = F.array_sort(F.collect_list(F.struct("_start", "_row", "value")))
    groups = numbered.groupBy("_file", "_pos").agg(pieces.alias("_pieces"), F.max("_end").alias("_whole"))
    text = F.array_join("_pieces.value", "}")
    items = groups.select("_file", "_pos", "_whole", text.alias("_raw"))
    lead = F.regexp_extract("_raw", r"^([^{]*)", 1)
    odd = F.regexp_replace(lead, r"\s", "")
    first = F.when(F.col("_pos") == 0, "[").otherwise(",")
    body = F.concat(F.substr("_raw", F.char_length(lead) + 1), F.lit("}"))
    # what follows the last object is the end of the array
    tail = F.regexp_replace("_raw", r"\s", "")
    items = items.where((F.col("_whole") == 1) | ~tail.isin("]", "[]", ""))
    good = (F.col("_whole") == 1) & (odd == first)
    if not keep:
        reason = F.concat(F.lit("not an array of objects: "), "_file")
        body = F.when(good, body).otherwise(F.raise_error(reason))
        item = F.from_json(body, SUBMISSION_SCHEMA, {"mode": "FAILFAST"})
        parsed = items.select("_file", "_pos", item.alias("_item")).select("_file", "_pos", "_item.*")
        return number_items(written(parsed, "items"))
    texts = items.select("_file", "_pos", F.when(good, body).otherwise(F.concat(F.lit("?"), "_raw")).alias("_text"))
    return number_items(written(_read_item(texts, ["_file", "_pos"]), "items"))


def number_items(items: DataFrame) -> DataFrame:
    """Items with ``_file`` and ``_pos`` to submissions with ``seq`` 1, 2, ..."""
    counts = items.groupBy("_file").agg(F.count("*").alias("_n"))
    offsets = running_totals(counts, ["_file"], "_n")
    seq = (F.col("_before") + F.col("_pos") + 1).alias("seq")
    errors = ["error"] if "error" in items.columns else []
    return items.join(offsets, "_file").select(seq, *SUBMISSION_SCHEMA.names, *errors)


def read_submission_lines(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """Submissions from files with one JSON object per line; these can be split.

    With ``on_error="keep"`` lines that cannot be read stay as rows with ``error``,
    as in ``read_submission_json``; otherwise the first one fails the job.
    """
    if _on_error(on_error):
        lines = spark.read.text(path).where(F.trim("value") != "").withColumn("_text", F.col("value"))
        return _numbered(_read_item(_placed(lines, ["_text"]), ["_file", "_start", "_row"]))
    rows = spark.read.schema(SUBMISSION_SCHEMA).option("mode", "FAILFAST").json(path)
    return _in_file_order(rows, [F.col(c) for c in SUBMISSION_SCHEMA.names])


def stream_submissions(spark: SparkSession, path: str, on_error: str = "fail", **options) -> DataFrame:
    """The same files as a stream: the items with ``_file`` and ``_pos``."""
    files = spark.readStream.options(wholetext=True, **options).format("text").load(path)
    files = files.select("value", F.col("_metadata.file_path").alias("_file"))
    return (_kept_items if _on_error(on_error) else _items)(files)


def stream_submission_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines of files with one JSON object per line as a stream, with ``_file`` and ``_start`` of their split."""
    lines = spark.readStream.options(**options).format("text").load(path)
    where = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
    return lines.where(F.trim("value") != "").select("value", *where)


def number_lines(lines: DataFrame, on_error: str = "fail") -> DataFrame:
    """A batch of such lines to submissions with ``seq`` 1, 2, ..."""
    placed = written(lines.withColumn("_row", F.monotonically_increasing_id()), "lines")
    if _on_error(on_error):
        items = placed.withColumn("_text", F.col("value"))
        return _numbered(_read_item(items, ["_file", "_start", "_row"]))
    item = F.from_json("value", SUBMISSION_SCHEMA, {"mode": "FAILFAST"})
    numbered = _numbered(placed.select("_file", "_start", "_row", item.alias("_item")))
    return numbered.select("seq", "_item.*")


def export_leads(leads: DataFrame, path: str, **filters) -> None:
    """Write matching leads as CSV files with a header, in order of ``id``.

    A null is an empty field, quotes are doubled, and fields are quoted only
    where needed. Rows end in a newline; other line ends would also change the
    line breaks inside fields. Part files are in order.
    """
    export_rows(leads, **filters).write.csv(
        path,
        header=True,
        escape='"',
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
