"""Mix sources to target weights: exact block quotas split over output shards by hypergeometric draws."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import count_words, keep, let, split_words, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 7
ROUNDS = 24
# Blocks that one row stands for until they are listed.
PART = 1024
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 16


@dataclass(frozen=True)
class Grid:
    """Words per block and number of output shards (a power of two)."""

    block: int
    depth: int

    @property
    def shards(self) -> int:
        return 1 << self.depth


def grid(words: int, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> Grid:
    """As many shards as make them shard_words long at most, blocks of one length in all of them."""
    return Grid(block_words, max(0, math.ceil(math.log2(max(1, words) / shard_words))))


def sized(documents: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text"):
    """One row per document row: doc_id, source, size in words, what orders it on its source's line, and a hash of the row."""
    text = text_of(f"`{text_column}`")
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    return documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        count_words(text).alias("size"),
        row_hash(documents).alias("_row_hash"),
        F.md5(F.concat(F.lit(f"{SEED}-"), name, F.lit("-"), F.md5(text))).alias("_place"),
    )


def row_hash(documents: DataFrame) -> Column:
    """A hash of all columns of a row, maps as their entries."""
    return F.xxhash64(*[
        F.map_entries(f"`{c}`") if kind.startswith("map") else F.col(f"`{c}`") for c, kind in documents.dtypes
    ])


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> source, number, source_size, target, drawn (the target in whole words).

    Sources by code point, null last, weigh 3, 1, 2 and so on. A source is capped at EPOCHS times its size
    and the rest shared by weight again: with sources by cap per weight, the common level is the largest of
    the levels that result if all before each one are capped. One row per source.
    """
    numbered = sizes.withColumn(
        "number", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    ).withColumn("weight", F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.col("number") - 1, F.lit(len(WEIGHTS)))))
    cap = EPOCHS * F.col("source_size")
    by_level = Window.orderBy(cap / F.col("weight"), "number")
    before = F.coalesce(F.sum(cap).over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy(F.lit(0))
    return (
        numbered.withColumn("level", (SHARE * F.sum("source_size").over(every) - before) / rest)
        .withColumn("target", F.least(cap.cast("double"), F.max("level").over(every) * F.col("weight")))
        .withColumn("drawn", F.floor(F.col("target") + 0.5).cast("bigint"))
        .select("source", "number", "source_size", "target", "drawn")
    )


def draws(
    documents: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, draws (epoch, first, taken, shard, position).

    Each source's documents lie in a keyed order on a line of words, repeated once more for a second epoch. The mix takes
    the line's first `drawn` words, so no document more than EPOCHS times, and cuts them into blocks. The splitting
    tree gives each shard an exact number of every source's blocks; a permutation of a source's blocks tells which
    these are. A document is cut where a block ends: each draw is the words of it in one block, `taken` words from
    word `first` on. Positions shuffle the draws of a shard. So a shard has the words of its quotas, all
    blocks being whole but the last of a source. Runs agree: all depends on the seed, ids and texts alone.

    A null text has size 0 and no draws; a null source is a source of its own, the last. Repeated rows are
    documents of their own. Ties of the order go by id and a hash of the row. Other columns are ignored.
    An empty table gives no rows.

    Prefix sums run per source and range of the order, with offsets from a table of range totals, so a source
    with most of the rows is spread over all tasks. Texts are not shuffled.
    """
    rows = keep(sized(documents, id_column, source_column, text_column), "mix-sizes")
    totals = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    digits = max(3, math.ceil(math.log(max(1, totals[0] / 4096), 16)))
    rows = rows.withColumn("range", F.substring("_place", 1, digits))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sources = keep(targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size"))), "mix-targets")
    plan = grid(int(SHARE * totals[1]), block_words, shard_words)
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("words").over(along), F.lit(0))).alias("o")
    offsets = offsets.join(sources.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source"))).select(
        "o.source", "range", "offset", "number", "source_size", "target", "drawn"
    )
    inside = Window.partitionBy("source", "range").orderBy("_place", "doc_id", "size", "_row_hash")
    started = rows.withColumn(
        "inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    columns = ["doc_id", "source", "size", "_row_hash", "source_size", "target", "number", "start"]
    placed = (
        started.alias("d")
        .join(
            offsets.alias("o"),
            (F.col("d.range") == F.col("o.range")) & F.col("d.source").eqNullSafe(F.col("o.source")),
        )
        .withColumn("start", F.col("inside") + F.col("offset"))
        .select("d.source", *[c for c in columns if c != "source"], "drawn")
    )
    taken = (F.col("size") > 0) & (F.col("start") < F.col("drawn"))
    pieces = placed.filter(taken).select(*columns, F.explode(_pieces(plan.block)).alias("piece")).select(*columns, "piece.*")
    sharded = pieces.join(block_shards(sources, plan), ["number", "block"])
    shuffled = F.md5(F.concat_ws("-", F.lit(SEED), "doc_id", "epoch", "start", "first"))
    local = Window.partitionBy("shard").orderBy(shuffled, "number", "start", "epoch", "first")
    drawn = F.struct("epoch", "first", "taken", "shard", F.row_number().over(local).cast("bigint").alias("position"))
    # Positive sizes make (number, start) a key of the rows.
    told = sharded.withColumn("draw", drawn).groupBy(*columns).agg(
        F.sort_array(F.collect_list("draw")).alias("draws")
    )
    empty = F.array().cast("array<struct<epoch:int,first:bigint,taken:bigint,shard:bigint,position:bigint>>")
    kept = [c for c in columns if c not in ("number", "start")]
    return told.select(*kept, "draws").unionByName(placed.filter(~taken).select(*kept, empty.alias("draws")))


def mixed(documents: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text", **grid_words):
    """The mix itself: a struct of the columns of documents for each draw, and beside it epoch, shard and position.

    A draw that is not the whole document has its words joined by single spaces; all others keep their text as it is.
    Rows lie by shard, in the order of positions. A text travels twice: to its draws, then to their shards.
    """
    drawn = draws(documents, id_column, source_column, text_column, **grid_words).filter(F.size("draws") > 0)
    drawn = drawn.select(
        F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("_row_hash").alias("_hash"), "size", F.explode("draws").alias("draw")
    )
    # Rows that are equal in all columns are one row with the draws of all of them.
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), row_hash(documents).alias("_hash")
    )
    rows = rows.withColumn("_id", F.coalesce(F.col("_row")[id_column].cast("bigint"), F.lit(0)))
    rows = rows.groupBy("_id", "_hash").agg(F.first("_row").alias("_row"))
    words = split_words(F.col("_row")[text_column].cast("string"))
    cut = F.array_join(F.slice(words, F.col("draw.first").cast("int") + 1, F.col("draw.taken").cast("int")), " ")
    text = F.when(F.col("draw.taken") == F.col("size"), F.col("_row")[text_column]).otherwise(cut)
    mix = rows.join(drawn, ["_id", "_hash"]).select(
        F.col("_row").withField(f"`{text_column}`", text).alias("row"), "draw.epoch", "draw.shard", "draw.position"
    )
    return mix.repartition("shard").sortWithinPartitions("shard", "position")


def block_shards(sources: DataFrame, plan: Grid) -> DataFrame:
    """number, block, shard: every block of every source once; each shard has as many as its quotas say."""
    blocks = _blocks(plan.block)
    many = F.sequence(F.lit(0).cast("bigint"), F.greatest(blocks - 1, F.lit(0)), F.lit(PART).cast("bigint"))
    parts = sources.withColumn("blocks", blocks).filter("blocks > 0").select("number", "blocks", F.explode(many).alias("part"))
    inner = F.sequence(F.col("part"), F.least(F.col("part") + PART, F.col("blocks")) - 1)
    # The rows are few until they are listed: a given number of tasks is not joined to one.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = parts.repartition(tasks, "number", "part").select("number", "blocks", F.explode(inner).alias("block"))
    listed = listed.withColumn("rank", permuted(F.col("block"), F.col("blocks"), F.col("number")))
    spans = shard_spans(sources, plan).withColumnsRenamed({"number": "n", "cell": "c"})
    return listed.withColumn("cell", F.floor(F.col("rank") / _cell(plan.shards))).join(
        spans,
        (F.col("number") == F.col("n")) & (F.col("cell") == F.col("c"))
        & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("end")),
    ).select("number", "block", "shard")


def keyed(*parts: Column | int) -> Column:
    """52 bits of MD5 over the seed and the parts."""
    told = F.concat_ws("-", F.lit(SEED), *[(F.lit(p) if isinstance(p, int) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(told), 1, 13), 16, 10).cast("bigint")


def permuted(value: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. size - 1 by the swap-or-not shuffle.

    A round pairs each number with its mirror at a keyed point and swaps the pair if a keyed bit says so.
    """

    def step(x: Column, number: Column) -> Column:
        point = keyed(number, key) % size
        return let(
            F.struct(x.alias("x"), F.pmod(point - x, size).alias("y")),
            lambda pair: F.when(
                keyed(number, key, F.greatest(pair["x"], pair["y"])) % 2 == 1, pair["y"]
            ).otherwise(pair["x"]),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), value, step)


def shard_spans(sources: DataFrame, plan: Grid) -> DataFrame:
    """number, shard, from, end, cell: each shard's span of every source's permuted blocks, once per cell it touches.

    A cell is as long as a shard's even part of the blocks, so a span meets few cells and a cell few spans:
    finding the span of a block is an equality join.
    """
    leaves = splitting_tree(sources, plan)
    quota = leaves.select(
        F.col("node").alias("shard"), F.posexplode("quotas").alias("at", "quota")
    ).filter("quota > 0").withColumn("number", F.col("at") + 1)
    along = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        quota.withColumn("end", F.sum("quota").over(along))
        .join(sources.select("number", _blocks(plan.block).alias("blocks")), "number")
        .withColumn("from", F.col("end") - F.col("quota"))
    )
    size = _cell(plan.shards)
    cells = F.sequence(F.floor(F.col("from") / size), F.floor((F.col("end") - 1) / size))
    return spans.select("number", "shard", "from", "end", F.explode(cells).alias("cell"))


def splitting_tree(sources: DataFrame, plan: Grid) -> DataFrame:
    """node, quotas: the leaves of the tree; quotas holds the blocks of each source by number.

    The root has every source's blocks. A node's blocks are halved, and a multivariate hypergeometric draw
    tells how many of each source go to the left half: what a random permutation of the blocks would give,
    without touching them. The quotas of a source always sum to its blocks. One row per node.
    """
    nodes = sources.select("number", _blocks(plan.block).alias("blocks")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("number", "blocks"))), lambda s: s["blocks"]).alias("quotas")
    ).select(F.lit(0).cast("bigint").alias("node"), "quotas")
    for level in range(plan.depth):
        if level == 6:
            nodes = nodes.repartition("node")
        left = multivariate_draw(F.col("quotas"), level, F.col("node"))
        halves = nodes.select("node", "quotas", left.alias("left"))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        nodes = halves.select(
            F.explode(F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
                F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
            )).alias("half")
        ).select("half.*")
    return nodes


def multivariate_draw(quotas: Column, level: int, node: Column) -> Column:
    """How many of each quota lie in a random half: hypergeometric draws, each given those before it."""
    total = F.aggregate(quotas, F.lit(0).cast("bigint"), lambda a, q: a + q)

    def step(state: Column, quota: Column) -> Column:
        number = F.size(state["out"])
        uniform = keyed(level, node, number) * 2.0**-52
        drawn = hypergeometric(state["rest"], quota, state["want"], uniform)
        return let(
            drawn,
            lambda x: F.struct(
                (state["rest"] - quota).alias("rest"),
                (state["want"] - x).alias("want"),
                F.concat(state["out"], F.array(x)).alias("out"),
            ),
        )

    start = F.struct(
        total.alias("rest"),
        F.floor((total + keyed(level, node) % 2) / 2).alias("want"),
        F.array().cast("array<bigint>").alias("out"),
    )
    return F.aggregate(quotas, start, step, lambda state: state["out"])


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """A hypergeometric variate by inversion: marked ones among `drawn` of `total`.

    Weights start with 1 at the mode and follow from their ratios, upwards and downwards, so none under- or
    overflows; twelve standard deviations hold all that double precision can tell from 0.
    """

    def body(a: Column) -> Column:
        n, k, m, u = a["n"], a["k"], a["m"], a["u"]
        low, high = F.greatest(F.lit(0.0), m - (n - k)), F.least(m, k)
        mode = F.greatest(low, F.least(high, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
        spread = F.sqrt(F.greatest(m * k / n * (n - k) / n * (n - m) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0)))
        far = F.ceil(12 * spread).cast("double") + 30
        return let(
            F.struct(
                n.alias("n"), k.alias("k"), m.alias("m"), u.alias("u"), mode.alias("mode"),
                _steps(F.least(high, mode + far) - mode).alias("up"),
                _steps(mode - F.greatest(low, mode - far)).alias("down"),
            ),
            _invert,
        )

    given = F.struct(
        total.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("m"),
        uniform.alias("u"),
    )
    return F.when((marked == 0) | (drawn == 0), F.lit(0).cast("bigint")).otherwise(
        F.when(drawn == total, marked).otherwise(let(given, body).cast("bigint"))
    )


def _steps(count: Column) -> Column:
    return F.when(count >= 1, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))


def _invert(a: Column) -> Column:
    n, k, m, mode = a["n"], a["k"], a["m"], a["mode"]

    def higher(i: Column) -> Column:
        x = mode + i - 1
        return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

    def lower(i: Column) -> Column:
        x = mode - i + 1
        return x * (n - k - m + x) / ((k - x + 1) * (m - x + 1))

    def mass(ratio):
        def step(s: Column, i: Column) -> Column:
            return let(s["w"] * ratio(i), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))

        return step

    def walk(ratio, sign: int):
        def step(s: Column, i: Column) -> Column:
            return let(
                s["w"] * ratio(i),
                lambda w: F.struct(
                    w.alias("w"),
                    (s["left"] - w).alias("left"),
                    F.when(s["pick"].isNull() & (s["left"] < w), mode + sign * i).otherwise(s["pick"]).alias("pick"),
                ),
            )

        return step

    one = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    up = F.aggregate(a["up"], one, mass(higher), lambda s: s["sum"])
    down = F.aggregate(a["down"], one, mass(lower), lambda s: s["sum"])
    nothing = F.lit(None).cast("double")

    def from_(left: Column) -> Column:
        return F.struct(F.lit(1.0).alias("w"), left.alias("left"), nothing.alias("pick"))

    return let(
        F.struct(up.alias("up"), (a["u"] * (1 + up + down) - 1).alias("left")),
        lambda t: F.when(t["left"] < 0, mode).otherwise(
            F.coalesce(
                F.aggregate(a["up"], from_(t["left"]), walk(higher, 1), lambda s: s["pick"]),
                F.aggregate(a["down"], from_(t["left"] - t["up"]), walk(lower, -1), lambda s: s["pick"]),
                mode,
            )
        ),
    )


def _blocks(block: int) -> Column:
    return F.ceil(F.col("drawn") / block).cast("bigint")


def _cell(shards: int) -> Column:
    """Blocks per cell."""
    return F.greatest(F.lit(1), F.ceil(F.col("blocks") / shards))


def _pieces(block: int) -> Column:
    """What the mix takes of a document: for each epoch, the words in each block: block, first word, words."""

    def piece(epoch: int) -> Column:
        at = F.col("start") + epoch * F.col("source_size")
        end = at + F.least(F.col("size"), F.col("drawn") - at)
        within = F.sequence(F.floor(at / block).cast("bigint"), F.floor((end - 1) / block).cast("bigint"))
        return F.when(end > at, F.transform(within, lambda b: F.struct(
            F.lit(epoch).alias("epoch"), b.alias("block"), (F.greatest(at, b * block) - at).alias("first"),
            (F.least(end, (b + 1) * block) - F.greatest(at, b * block)).alias("taken"),
        ))).otherwise(F.array().cast("array<struct<epoch:int,block:bigint,first:bigint,taken:bigint>>"))

    return F.concat(*[piece(e) for e in range(EPOCHS)])
