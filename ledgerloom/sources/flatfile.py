"""Sectioned vendor flat files.

A file holds a list of field names between START-OF-FIELDS and END-OF-FIELDS and ``|``-delimited
rows between START-OF-DATA and END-OF-DATA (or END-OF-FILE).  Which section a line belongs to
depends on the lines before it, yet a single file may be far too large for one task.  So the text
is read once, split like any text file, and its lines are written to a staging table with their
position (file, block, row).  The few section markers then give the line ranges of each file, and
a broadcast join on those ranges picks the data rows, whichever split they came from.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import keys as K
from ..functions import scalar as S
from ..session import checkpoint_folder, materialize, small_side

FIELDS_OPEN, FIELDS_CLOSE = "START-OF-FIELDS", "END-OF-FIELDS"
DATA_OPEN, DATA_CLOSE = "START-OF-DATA", ("END-OF-DATA", "END-OF-FILE")
MARKERS = [FIELDS_OPEN, FIELDS_CLOSE, DATA_OPEN, *DATA_CLOSE]

MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")


def stage_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Write the lines of the files, with position and file identity, to the checkpoint folder."""
    path = F.col("_metadata.file_path")
    line = F.btrim("value", F.lit(S.LINE_PADDING))
    marker = line.isin(MARKERS)
    rows = spark.read.text([paths] if isinstance(paths, str) else list(paths)).select(
        path.alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("pos"),
        line.alias("line"),
        marker.alias("marker"),
        # Names and comments carry no delimiter; row groups without any are skipped later.
        (marker | ~line.contains("|")).alias("bare"),
        S.file_region(path).alias("region"),
        S.file_type(path).alias("file_type"),
    )
    target = f"{checkpoint_folder(spark).rstrip('/')}/flatfile-{uuid.uuid4().hex}"
    rows.write.partitionBy("file_type").parquet(target)
    # Partition values stay text: a type such as "1" is not a number.
    return spark.read.schema(rows.schema).parquet(target)


def sections(staged: DataFrame) -> DataFrame:
    """(file, start, stop, kind) of every stretch between two markers that holds names or data.

    The window runs over marker lines only, a handful per file.
    """
    marks = staged.where("marker").select("file", "pos", "line")
    w = Window.partitionBy("file").orderBy("pos")
    line = F.col("line")
    naming = F.last(F.when(line == FIELDS_OPEN, True).when(line == FIELDS_CLOSE, False), ignorenulls=True).over(w)
    filling = F.last(F.when(line == DATA_OPEN, True).when(line.isin(*DATA_CLOSE), False), ignorenulls=True).over(w)
    kind = F.when(naming, "names").when(filling, "data")
    return marks.select(
        "file", F.col("pos").alias("start"), F.lead("pos").over(w).alias("stop"), kind.alias("kind")
    ).where(F.col("kind").isNotNull())


def _inside(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines strictly between the ends of a range of their file."""
    r = ranges.withColumnRenamed("file", "__file")
    after = F.col("pos") > F.col("start")
    before = F.col("stop").isNull() | (F.col("pos") < F.col("stop"))
    return lines.join(r, (F.col("file") == F.col("__file")) & after & before).drop("__file", "start", "stop")


def field_names(staged: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(file, names): the three leading columns, then the listed field names in file order."""
    ranges = sections(staged) if ranges is None else ranges
    naming = ranges.where(F.col("kind") == "names").drop("kind")
    lines = staged.where("bare").select("file", "pos", "line")
    if not _all_bare(_inside(lines, naming), naming):
        lines = staged.select("file", "pos", "line")
    listed = (
        _inside(lines, naming)
        .groupBy("file")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("listed"))
    )
    prefix = F.array(*[F.lit(c) for c in K.FLATFILE_PREFIX])
    names = F.concat(prefix, F.coalesce(F.col("listed.line"), F.array().cast("array<string>")))
    files = ranges.select("file").distinct()
    return files.join(listed, "file", "left").select("file", names.alias("names"))


def _all_bare(found: DataFrame, naming: DataFrame) -> bool:
    """Whether the lines without a delimiter are all the lines of the name sections.

    Rows of one block are numbered without gaps, so a section inside one block shows how many
    lines it has.
    """
    expected = naming.agg(
        F.coalesce(F.bool_and(F.col("start.block") == F.col("stop.block")), F.lit(True)).alias("one_block"),
        F.coalesce(F.sum(F.col("stop.row") - F.col("start.row") - 1), F.lit(0)).alias("lines"),
    ).first()
    return bool(expected.one_block) and found.count() == expected.lines


def parse_rows(staged: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """The data rows of all staged files as text columns, unioned by name.

    ``N.A.`` is NULL, an empty value stays empty.  A row whose width differs from its header fails
    (``FAILFAST``), is padded or cut (``PERMISSIVE``), or is left out (``DROPMALFORMED``).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    ranges = small_side(sections(staged))
    names = materialize(field_names(staged, ranges).withColumn("hash", F.xxhash64("names")))
    # Different field lists are few: they are versions of a file type, not files.
    found = sorted(names.select("hash", "names").distinct().collect(), key=lambda r: (-len(r.names), r.names))
    hashes, layouts = [r["hash"] for r in found], [r.names for r in found]
    if len(set(hashes)) != len(hashes):
        raise ValueError("two field lists have the same hash")
    for layout in layouts:
        if len(set(layout)) != len(layout):
            raise ValueError(f"a file lists a field twice: {layout}")
    columns = list(dict.fromkeys(c for layout in layouts for c in layout)) or list(K.FLATFILE_PREFIX)
    layout = (F.array_position(F.lit(hashes or [0]), F.col("hash")) - 1).cast("int")
    files = names.select("file", F.size("names").alias("width"), layout.alias("layout"))
    data = small_side(ranges.where(F.col("kind") == "data").drop("kind").join(files, "file"))
    rows = _inside(staged.select("file", "pos", "line", "region", "file_type"), data).withColumn(
        "values", F.split("line", r"\|")
    )
    # The piece after the last delimiter is not a value.
    fits = F.size("values") - 1 == F.col("width")
    if mode == "FAILFAST":
        # A filter, which no choice of columns prunes.  What is not deterministic stays above the join, so only rows
        # inside a data section are looked at.
        problem = F.raise_error(F.concat(F.lit("row width differs from header in "), F.col("file"))).cast("boolean")
        rows = rows.where(F.when(fits & (F.monotonically_increasing_id() >= 0), F.lit(True)).otherwise(problem))
    elif mode == "DROPMALFORMED":
        rows = rows.where(fits)
    else:
        rows = rows.withColumn("values", F.expr("slice(values, 1, size(values) - 1)"))

    def value(name: str) -> Column:
        # Where each layout has the field; -1 reads as NULL.
        places = [x.index(name) if name in x else -1 for x in layouts] or [-1]
        place = F.lit(places[0]) if len(set(places)) == 1 else F.get(F.lit(places), F.col("layout"))
        return S.null_token(F.get("values", place)).alias(name)

    return rows.select("file", "region", "file_type", *[value(c) for c in columns])


def read_flatfiles(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "FAILFAST",
    operation_date: bool = True,
    identity: bool = False,
) -> DataFrame:
    """All-text frame of one or many files; ``OPERATION_DATE`` is today."""
    rows = parse_rows(stage_lines(spark, paths), mode)
    if operation_date:
        rows = rows.withColumn("OPERATION_DATE", F.current_date())
    return rows if identity else rows.drop("file", "region", "file_type")


def read_by_type(
    spark: SparkSession, paths: str | Sequence[str], mode: str = "FAILFAST", operation_date: bool = True
) -> dict[str, DataFrame]:
    """One frame per file type found in the file names; types without data rows are left out."""
    staged = stage_lines(spark, paths)
    kinds = [r.file_type for r in staged.select("file_type").distinct().orderBy("file_type").collect()]
    frames = {}
    for kind in kinds:
        rows = parse_rows(staged.where(F.col("file_type") == kind), mode).drop("file", "region", "file_type")
        if not rows.isEmpty():
            frames[kind] = rows.withColumn("OPERATION_DATE", F.current_date()) if operation_date else rows
    return frames
