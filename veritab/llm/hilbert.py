"""Sharding along a Hilbert curve (DataFrame functions only).

Several metadata columns are quantised to a grid, the grid cells are ordered by their Hilbert index, and the
rows in that order are cut into equal runs. Rows of one shard then lie close together in every quantised
column, so a reader can skip whole shards on any of them.

The order of the rows is global but no task ever sorts more than a measured share: rows are counted per grid
cell (map-side combined), a cell with many rows is spread over hash sub-cells, the sub-cells get their first
position from running totals over the small (cell, sub-cell) table, and only the rows inside one sub-cell are
numbered by a window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veritab.llm.store import materialize

SUBCELL_ROWS = 1_000  # least size aimed at; larger tables aim at the square root of their rows


def hilbert_index(coords: list[Column], bits: int) -> Column:
    """Position on the Hilbert curve of a grid point whose coordinates have ``bits`` bits each."""
    n = len(coords)
    if n == 1:
        return coords[0].cast("long")
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        p = s["q"] - 1
        bit = x[s["i"]].bitwiseAND(s["q"]) != 0
        swap = x[0].bitwiseXOR(x[s["i"]]).bitwiseAND(p)
        head = F.when(bit, x[0].bitwiseXOR(p)).otherwise(x[0].bitwiseXOR(swap))
        return F.transform(x, lambda v, k: F.when(k == 0, head).when((k == s["i"]) & ~bit, v.bitwiseXOR(swap)).otherwise(v))

    turned = F.aggregate(steps, F.array(*[c.cast("int") for c in coords]), undo) if bits > 1 else F.array(*[c.cast("int") for c in coords])
    # Gray code: every coordinate becomes the exclusive-or of itself and all earlier ones
    gray = F.transform(turned, lambda v, k: F.aggregate(F.slice(turned, 1, k + 1), F.lit(0), lambda a, e: a.bitwiseXOR(e)))

    def fold(g: Column) -> Column:
        last = g[n - 1]
        t = reduce(lambda a, b: a.bitwiseXOR(b), [F.when(last.bitwiseAND(1 << b) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)) for b in range(bits - 1, 0, -1)], F.lit(0))
        digits = [F.shiftleft(F.shiftright(g[i].bitwiseXOR(t), b).bitwiseAND(1).cast("long"), b * n + n - 1 - i) for b in range(bits) for i in range(n)]
        return reduce(lambda a, b: a + b, digits)

    return F.transform(F.array(gray), fold)[0]


def shard_by_curve(df: DataFrame, cells: dict[str, Column], order: list[Column], shards: int = 8, bits: int = 4) -> DataFrame:
    """Add ``shard`` (0 … shards-1) and ``slot`` (gapless from 0 within the shard) to every row of ``df``.

    ``cells`` names the quantised coordinates (integers below 2**bits); ``order`` breaks ties inside a cell.
    Shard sizes differ by at most one row. Rows equal in every ordering column are interchangeable. An empty
    table gives an empty result."""
    reserved = {"__cell", "__sub", "__n", "__first", "__total", "__rank"}
    if reserved & set(df.columns):
        raise ValueError(f"columns {sorted(reserved & set(df.columns))} are reserved")
    names = list(cells)
    grid = df.withColumns({f"__{c}": v for c, v in cells.items()})
    curve = grid.withColumn("__cell", hilbert_index([F.col(f"__{c}") for c in names], bits)).drop(*[f"__{c}" for c in names])
    curve = curve.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(1 << 30)))
    # few cells: 2**(bits * dimensions) at most
    sizes = curve.groupBy("__cell").agg(F.count("*").alias("__n"))
    # sub-cells of about sqrt(rows) rows: the window of a sub-cell and the table of sub-cells both stay small
    aim = F.greatest(F.lit(float(SUBCELL_ROWS)), F.sqrt(sizes.agg(F.sum("__n").cast("double")).scalar()))
    split = sizes.select("__cell", F.ceil(F.col("__n") / aim).cast("int").alias("__subs"))
    # cells are bounded by 2**(bits * dimensions), so the table of splits can be broadcast
    rows = curve.join(F.broadcast(split) if bits * len(names) <= 14 else split, "__cell").withColumn("__sub", F.floor(F.col("__salt") * F.col("__subs") / (1 << 30)).cast("int"))
    rows = materialize(rows.drop("__subs"), "curve")
    counts = rows.groupBy("__cell", "__sub").agg(F.count("*").alias("__n"))
    first = counts.withColumn("__cell_first", F.coalesce(F.sum("__n").over(W.orderBy("__cell", "__sub").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    total = first.agg(F.sum("__n").alias("t"))
    first = first.withColumn("__total", total.scalar()).select("__cell", "__sub", F.col("__cell_first").alias("__first"), "__total")
    ranked = rows.withColumn("__rank", F.row_number().over(W.partitionBy("__cell", "__sub").orderBy("__salt", *order)) - 1)
    out = ranked.join(first, ["__cell", "__sub"]).withColumn("__rank", F.col("__rank") + F.col("__first"))
    # shard s holds ranks ceil(s*N/shards) … ceil((s+1)*N/shards)-1: sizes differ by one at most
    shard = F.floor(F.expr(f"__rank * {shards} div __total")).cast("int")
    out = out.withColumn("shard", shard)
    begin = F.expr(f"(shard * __total + {shards - 1}) div {shards}")
    return out.withColumn("slot", (F.col("__rank") - begin).cast("long")).drop("__cell", "__sub", "__salt", "__rank", "__first", "__total")


def _level(c: Column, most: int) -> Column:
    return F.least(F.greatest(c, F.lit(0)), F.lit(most)).cast("int")


def document_cells(bits: int = 4) -> dict[str, Column]:
    """Grid of the documents table: size (two steps per doubling), language and source (hash buckets)."""
    most = (1 << bits) - 1
    return {
        "size": _level(F.floor(F.log2(F.col("size").cast("double"))) - 2, most),
        "lang": F.pmod(F.hash(F.coalesce(F.col("lang"), F.lit(""))), F.lit(1 << bits)).cast("int"),
        "source": F.pmod(F.hash(F.coalesce(F.col("source"), F.lit(""))), F.lit(1 << bits)).cast("int"),
    }


def shard_documents(docs: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """doc_id, lang, source, size (UTF-8 bytes of the text plus one; null text: 1), text_crc32 and the shard and
    slot of every document. The text itself is read once and never shuffled; missing lang or source columns
    and null values count as empty strings."""
    for c in ("lang", "source"):
        if c not in docs.columns:
            docs = docs.withColumn(c, F.lit(None).cast("string"))
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    meta = docs.select("doc_id", "lang", "source", size.alias("size"), F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("text_crc32"))
    order = [F.col("text_crc32"), F.col("size"), F.col("doc_id"), F.col("lang"), F.col("source")]
    return shard_by_curve(meta, document_cells(), order, shards)
