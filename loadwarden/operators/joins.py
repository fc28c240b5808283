from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

from loadwarden.frames import small_frame

#: A key that gives more joined rows than this is dealt to several tasks.
CELL_ROWS = 10_000_000
#: Keys that a sketch reports, and those that it keeps counters for.
REPORTED, TRACKED = 256, 16_384
#: Cells in all, and for each partition of the shuffle where that is more; rows are copied by the root of their number.
LEAST_CELLS, CELLS_EACH = 256, 4
#: The most rows of the right that are packed into one; a key that holds a share of them gives that share.
PACKED_ROWS = 4096

_GRID = StructType([StructField(name, LongType()) for name in ("key", "rows", "columns")])


def inner_join_using(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner equi-join; the key columns come once and first.

    Rows with a NULL key drop out, duplicate keys multiply, and text matches
    exactly. There is no broadcast hint: Spark broadcasts a side whose measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles
    both, where adaptive execution splits the partition of a hot key over many
    tasks.
    """
    return left.join(right, on=list(on), how="inner")


def hot_keys(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    cell_rows: int = CELL_ROWS,
    reported: int = REPORTED,
    tracked: int = TRACKED,
    most_cells: int | None = None,
) -> list[tuple[int, int, int]]:
    """Hashes of the keys that give more than ``cell_rows`` joined rows, and a grid for each.

    Each side's heaviest keys come from a sketch of fixed size, built in every task and merged, over the key columns
    alone; at most ``reported`` of a side come to the driver. A key that only one side reports
    has at most as many rows in the other as the lightest that is reported there. In a cell of
    ``rows`` by ``columns`` of them meet about ``cell_rows`` rows, or more where all keys
    together would have more than about ``most_cells`` cells.
    """
    (lefts, left_rest), (rights, right_rest) = (_heaviest(df, on, reported, tracked) for df in (left, right))
    sizes = [(key, lefts.get(key, left_rest), rights.get(key, right_rest)) for key in sorted(lefts.keys() | rights.keys())]
    if most_cells is not None:
        joined = sum(in_left * in_right for _, in_left, in_right in sizes if in_left * in_right > cell_rows)
        cell_rows = max(cell_rows, joined // most_cells)
    found = []
    for key, in_left, in_right in sizes:
        if in_left * in_right > cell_rows:
            # Square cells copy the fewest rows; a side with less than an edge is not cut.
            edge = max(int(cell_rows**0.5), 1)
            high = min(in_left, max(edge, cell_rows // in_right))
            wide = min(in_right, max(cell_rows // high, 1))
            found.append((key, ceil(in_left / high), ceil(in_right / wide)))
    return found


def _heaviest(df: DataFrame, on: Sequence[str], reported: int, tracked: int) -> tuple[dict[int, int], int]:
    """Rows of the heaviest keys by their hash, and how many any other key has at most."""
    keys = df.select(*(f"`{name}`" for name in on)).na.drop()
    top = keys.select(F.xxhash64(*keys.columns).alias("key")).agg(
        F.expr(f"approx_top_k(key, {reported}, {tracked})").alias("top")
    )
    rows = top.first()["top"] or []
    return {row["item"]: row["count"] for row in rows}, rows[-1]["count"] if len(rows) == reported else 0


def inner_join_hot(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    cell_rows: int = CELL_ROWS,
    reported: int = REPORTED,
    tracked: int = TRACKED,
) -> DataFrame:
    """``inner_join_using`` where keys may be hot on both sides.

    The joined rows of a hot key form a grid: each row of the left lies in one of its rows and is copied to
    all of its columns, each row of the right the other way round, and every pair meets in one
    cell. The cells of a key are dealt like keys of their own, so that no task gets them all, also
    without adaptive execution, which can split only one side's rows and copies the other side whole. All
    other keys have a single cell. What a sketch misses or overrates costs balance, never a row.

    Cells are larger than ``cell_rows`` where there would be more than ``CELLS_EACH`` for each partition of the
    shuffle, and ``LEAST_CELLS`` in all, since the copies grow with the cells. The copies are shuffled on both sides: Spark
    takes a side's size without them, so it would broadcast a small one. Where they meet, the right's rows are packed
    into short runs, and each run goes by all of its cell's left rows before the next one. So a run's values come again and
    again within what a file's compression looks back on, which a cell's many rows would not.

    A row's place in the grid is its number, so the sides have to give the same rows when a lost task runs
    again, as scans do. Keys have the same types on both sides, and floating point is refused, since
    keys that are equal have to have equal hashes. NULLs join nothing.
    """
    on = list(on)
    for name in on:
        kinds = {df.select(f"`{name}`").schema[0].dataType for df in (left, right)}
        if len(kinds) > 1 or kinds & {FloatType(), DoubleType()}:
            listed = " and ".join(sorted(kind.simpleString() for kind in kinds))
            raise ValueError(f"the key {name} is {listed}; one type is needed that is no floating point")
    most_cells = max(LEAST_CELLS, CELLS_EACH * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(
        left, right, on, cell_rows=cell_rows, reported=reported, tracked=tracked, most_cells=most_cells
    )
    if not hot:
        return inner_join_using(left, right, on)
    taken = {name.lower() for df in (left, right) for name in df.columns}
    key, rows, columns, run, packed = (_free_name(name, taken) for name in (*_GRID.names, "run", "packed"))
    grid = small_frame(left.sparkSession, [dict(zip(_GRID.names, cells)) for cells in hot], _GRID).toDF(key, rows, columns)

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        number = F.monotonically_increasing_id()
        place = F.struct(
            F.coalesce(F.pmod(number, F.col(own)), F.lit(0)).alias("own"),
            F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), F.lit(1)) - 1).alias("other"),
        )
        keyed = df.withColumn(key, F.xxhash64(*(F.col(f"`{name}`") for name in on)))
        # At most twice ``reported`` rows are broadcast.
        joined = keyed.join(F.broadcast(grid), key, "left")
        names = [F.col(f"`{name}`") for name in df.columns]
        of_run = F.floor(number / (F.coalesce(F.col(own), F.lit(1)) * PACKED_ROWS)).alias(run)
        cells = joined.select(*names, place.alias(key), of_run)
        return cells.select(*names, F.col(key)["own"].alias(own), F.explode(F.col(key)["other"]).alias(other), run)

    exact = left.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    keys = {name if exact else name.lower() for name in on}
    left_on = [next(c for c in left.columns if c == name or not exact and c.lower() == name.lower()) for name in on]
    left_rest, right_rest = ([c for c in df.columns if (c if exact else c.lower()) not in keys] for df in (left, right))
    same = [*on, rows, columns]
    meet = [_free_name(f"meet{i}", taken) for i in range(len(same))]
    copies = placed(right, columns, rows).select(
        *(F.col(f"`{name}`").alias(other) for name, other in zip(same, meet)),
        run,
        F.struct(F.lit(True), *(F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(right_rest))).alias(packed),
    )
    # A run's rows lie where their cell does, so that packing them takes no shuffle of its own.
    runs = copies.repartition(*meet).groupBy(*meet, run).agg(F.collect_list(packed).alias(packed))
    cells = placed(left, rows, columns).drop(run)
    # A sorted join takes the second side's rows for each of the first's.
    joined = runs.hint("merge").join(cells, [F.col(m) == F.col(f"`{name}`") for name, m in zip(same, meet)])
    lefts = [F.col(f"`{name}`") for name in (*left_on, *left_rest)]
    unpacked = joined.select(*lefts, F.explode(packed).alias(packed))
    return unpacked.select(*lefts, *(F.col(packed)[f"c{i}"].alias(name) for i, name in enumerate(right_rest)))


def _free_name(name: str, taken: set[str]) -> str:
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"
