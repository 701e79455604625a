"""Bin packing by a grouping genetic algorithm on islands.

Documents become ids with ``end_id`` at the end; only those longer than a window
are cut, into full windows and a rest. A full window is a sequence of its own. The
other pieces are dealt by a hash of their row number into blocks of about ``BINS``
windows' worth of tokens, and each block is packed by itself:

- the first solution is best-fit decreasing; a block that meets the Martello-Toth
  lower bound is proven and done;
- any other block is evolved on ``ISLANDS`` islands, one row each. Crossover injects
  whole well-filled bins of one parent into the other, removes the other's bins that
  hold a document twice, and best-fits the documents displaced by that (largest
  first); mutation does the same to a few released bins. Fewer bins win, then fuller
  ones (sum of squared fills);
- after each epoch the elite of every island migrates to the next one of its block
  (a join), and an island that meets the bound rests.

The loosest bins of each block (at most an eighth of them) are not kept: their
pieces go up to the next level, where blocks are formed anew, until one block is
left. So blocks cost no more than their well-filled bins, and a level has at most
an eighth of the last one's tokens. No task holds more than one block and its
population, whatever the table; only counts reach the driver.

Defined results: a null or empty text is the end id alone; null IDs and repeated
rows are packed like others; an empty table packs to nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, table, text_or_empty
from tablefit.llm.tokens import vocabulary, word_encoder

WINDOW = 4096
END_ID = 1
BINS = 400
ISLANDS = 4
POPULATION = 8
EPOCHS = 3
GENERATIONS = 24
#: A bin with more than this share of a window empty is loose.
LOOSE = 1 / 64
STATE = ("block long, island int, nos array<long>, lengths array<int>, bound long, bins long, squares double, "
         "population array<array<int>>")


# --------------------------------------------------------------------------- documents to pieces
def pieces(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` (and ``ids`` if asked for)."""
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    spec = vocabulary(docs.sparkSession, vocab_path)

    def run(batches):
        import zlib

        import pyarrow as pa

        encode = word_encoder(spec.value)
        for b in batches:
            row, piece, length, crc, ids = [], [], [], [], []
            for k, t in enumerate(b.column(1)):
                x = np.append(encode(t.as_py()), np.uint32(end_id)).astype("<u4")
                for p in range(-(-len(x) // window)):
                    part = x[p * window:(p + 1) * window]
                    row.append(k)
                    piece.append(p)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array([p * window for p in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(cols, names)

    return src.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long"
                          + (", ids array<int>" if with_ids else ""))


# --------------------------------------------------------------------------- one block
def lower_bound(lengths: np.ndarray, window: int) -> int:
    """Martello and Toth's L2 bound on the bins of ``lengths``."""
    if not len(lengths):
        return 0
    x = np.sort(lengths)
    total = np.concatenate([[0], np.cumsum(x)])
    best = -(-int(total[-1]) // window)
    half = np.searchsorted(x, window // 2, side="right")  # items from here on exceed half a window
    for a in np.unique(x[:half]):
        big = np.searchsorted(x, window - a, side="right")  # alone in their bins if items below ``a`` are left out
        mid = total[big] - total[half]
        small = total[half] - total[np.searchsorted(x, a, side="left")]
        over = small - ((big - half) * window - mid)
        best = max(best, int(len(x) - half + max(0, -(-int(over) // window))))
    return max(best, len(x) - half)


def best_fit(items, lengths, fill: list[int], genome, window: int) -> None:
    """Put ``items``, in order, where least room is left that holds them; open bins as needed."""
    room = sorted((window - f, b) for b, f in enumerate(fill) if f < window)
    for i in items:
        size = lengths[i]
        k = bisect_left(room, (size, -1))
        if k < len(room):
            left, b = room.pop(k)
        else:
            left, b = window, len(fill)
            fill.append(0)
        genome[i] = b
        fill[b] += size
        if left > size:
            insort(room, (left - size, b))


def packed(lengths: list[int], order, window: int) -> np.ndarray:
    """A genome (bin of each item) by best fit in the given order."""
    genome = np.full(len(lengths), -1, np.int32)
    best_fit(order, lengths, [], genome, window)
    return genome


def merit(genome: np.ndarray, lengths: np.ndarray) -> tuple[int, float]:
    """Less is better: bins, then the negative sum of squared fills."""
    fill = np.bincount(genome, lengths)
    return len(fill), -float((fill * fill).sum())


def _rebuilt(kept: np.ndarray, lengths: np.ndarray, sizes: list[int], window: int, rng) -> np.ndarray:
    """``kept`` (-1: displaced) with bins renumbered and the displaced items best-fitted, largest first."""
    out = kept.copy()
    stay = kept >= 0
    names, out[stay] = np.unique(kept[stay], return_inverse=True)
    fill = [int(f) for f in np.bincount(out[stay], lengths[stay], minlength=len(names))]
    loose = np.flatnonzero(~stay)
    # Near-equal lengths change places, so that a second try differs from the first.
    loose = loose[np.argsort(-lengths[loose] * (1 - 0.02 * rng.random(len(loose))), kind="stable")]
    best_fit(loose.tolist(), sizes, fill, out, window)
    return out


def crossover(mother: np.ndarray, father: np.ndarray, lengths: np.ndarray, sizes: list[int], window: int, rng) -> np.ndarray:
    """Half of the father's better-filled bins whole, the mother's bins that share
    no item with them, and the displaced items by best fit."""
    fill = np.bincount(father, lengths)
    well = np.argsort(-fill, kind="stable")[:-(-len(fill) // 2)]
    chosen = np.zeros(len(fill), bool)
    chosen[well[rng.random(len(well)) < 0.5]] = True
    injected = chosen[father]
    hit = np.zeros(mother.max() + 1, bool)
    hit[mother[injected]] = True
    kept = np.where(injected, father, np.where(hit[mother], -1, mother + len(fill)))
    return _rebuilt(kept, lengths, sizes, window, rng)


def mutated(genome: np.ndarray, lengths: np.ndarray, sizes: list[int], window: int, rng) -> np.ndarray:
    """The emptiest bins and a few others released and packed again."""
    fill = np.bincount(genome, lengths)
    out = np.zeros(len(fill), bool)
    out[np.argsort(fill, kind="stable")[:2]] = True
    out[rng.integers(0, len(fill), size=int(rng.integers(2, 6)))] = True
    return _rebuilt(np.where(out[genome], -1, genome), lengths, sizes, window, rng)


def evolve(population: list[np.ndarray], lengths: np.ndarray, window: int, bound: int, rng, generations: int) -> list[np.ndarray]:
    """The population after some generations, best first; ends early at the bound."""
    sizes = [int(x) for x in lengths]
    scored = sorted(((merit(g, lengths), k, g) for k, g in enumerate(population)), key=lambda t: t[:2])
    born = len(scored)
    for _ in range(generations * len(scored)):
        if scored[0][0][0] <= bound:
            break
        m, f = (min(rng.integers(0, len(scored), size=2)) for _ in range(2))
        child = crossover(scored[m][2], scored[f][2], lengths, sizes, window, rng) if m != f else scored[m][2]
        if m == f or rng.random() < 0.3:
            child = mutated(child, lengths, sizes, window, rng)
        value = merit(child, lengths)
        if value < scored[-1][0] and all(value != s[0] for s in scored):
            scored[-1] = (value, born, child)
            born += 1
            scored.sort(key=lambda t: t[:2])
    return [g for _, _, g in scored]


# --------------------------------------------------------------------------- blocks as rows
def _emit(pa, rows):
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.float64(),
             pa.list_(pa.list_(pa.int32()))]
    names = [f.split()[0] for f in STATE.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def first_solutions(blocks: DataFrame, window: int) -> DataFrame:
    """``STATE`` rows of ``blocks(block, items)`` with the best-fit-decreasing genome."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for block, items in zip(b.column("block").to_pylist(), b.column("items")):
                nos = items.values.field("no").to_numpy()
                lengths = items.values.field("length").to_numpy().astype(np.int64)
                genome = packed(lengths.tolist(), range(len(lengths)), window)
                bins, squares = merit(genome, lengths)
                yield _emit(pa, [(block, 0, nos, lengths.astype(np.int32), lower_bound(lengths, window), bins, squares, [genome])])

    return blocks.mapInArrow(run, STATE)


def evolved(state: DataFrame, window: int, seed: int, level: int, epoch: int, generations: int) -> DataFrame:
    """One epoch of every island. Drawn from (seed, level, epoch, block, island), so a task run again does the same."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in range(b.num_rows):
                block, island, bound = (b.column(c)[r].as_py() for c in ("block", "island", "bound"))
                nos = b.column("nos")[r].values.to_numpy()
                lengths = b.column("lengths")[r].values.to_numpy().astype(np.int64)
                population = [np.asarray(g.values.to_numpy(), np.int32) for g in b.column("population")[r]]
                rng = np.random.default_rng([seed, level, epoch, block, island])
                while len(population) < POPULATION:  # largest first, but for chance
                    order = np.argsort(-lengths * (1 - 0.3 * rng.random(len(lengths))), kind="stable")
                    population.append(packed(lengths.tolist(), order.tolist(), window))
                population = evolve(population, lengths, window, bound, rng, generations)[:POPULATION]
                bins, squares = merit(population[0], lengths)
                yield _emit(pa, [(block, island, nos, lengths.astype(np.int32), bound, bins, squares, population)])

    return state.mapInArrow(run, STATE)


def migrated(state: DataFrame, islands: int) -> DataFrame:
    """Every island with the elite of the one before it in its block added."""
    elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.slice("population", 1, 1).alias("guest"))
    return (state.join(elite, ["block", "island"])
            .select("block", "island", "nos", "lengths", "bound", "bins", "squares", F.concat("population", "guest").alias("population")))


def solve(items: DataFrame, blocks: int, window: int, seed: int, level: int, islands: int, epochs: int, generations: int) -> DataFrame:
    """The best solution of every block: ``STATE`` rows whose population is one genome."""
    dealt = items.groupBy(F.pmod(F.xxhash64("no", F.lit(level)), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("length", "no")), asc=False).alias("items"))  # about BINS windows of tokens
    first = keep_table(first_solutions(dealt, window), "blocks")
    unproven = first.filter("bins > bound")
    if not unproven.count():
        return first
    state = (unproven.drop("island").withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
             .select(*first.columns).repartition("block", "island"))
    for epoch in range(epochs):
        state = keep_table(evolved(state, window, seed, level, epoch, generations), "islands")
        if epoch + 1 == epochs or not state.groupBy("block").agg(F.min(F.col("bins") - F.col("bound")).alias("over")).filter("over > 0").count():
            break
        state = migrated(state, islands)
    best = state.groupBy("block").agg(F.min_by(F.struct(*first.columns), F.struct("bins", "squares", "island")).alias("b")).select("b.*")
    return first.filter("bins <= bound").union(best.withColumn("population", F.slice("population", 1, 1)))


def placed(solved: DataFrame, window: int, level: int, last: bool) -> DataFrame:
    """``no, length, sequence_id, offset, up``; ``up``: in a loose bin, to be packed again."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for r in range(b.num_rows):
                nos = b.column("nos")[r].values.to_numpy()
                lengths = b.column("lengths")[r].values.to_numpy().astype(np.int64)
                genome = b.column("population")[r][0].values.to_numpy()
                fill = np.bincount(genome, lengths)
                loose = np.argsort(fill, kind="stable")[:-(-len(fill) // 8)]
                up = np.zeros(len(fill), bool)
                up[loose[fill[loose] < window * (1 - LOOSE)]] = not last
                by = np.argsort(genome, kind="stable")
                before = np.cumsum(lengths[by]) - lengths[by]
                start = np.searchsorted(genome[by], np.arange(len(fill)))
                offset = before - before[start[genome[by]]]
                name = (level << 56) + (b.column("block")[r].as_py() << 24)
                yield pa.record_batch([pa.array(nos[by]), pa.array(lengths[by]), pa.array(name + genome[by].astype(np.int64)),
                                       pa.array(offset), pa.array(up[genome[by]])], ["no", "length", "sequence_id", "offset", "up"])

    return solved.mapInArrow(run, "no long, length long, sequence_id long, offset long, up boolean")


def pack(cut: DataFrame, window: int = WINDOW, seed: int = 1, bins: int = BINS, islands: int = ISLANDS, epochs: int = EPOCHS,
         generations: int = GENERATIONS) -> DataFrame:
    """``cut`` (with ``length``, at most ``window``) plus ``sequence_id`` and ``offset``."""
    kept = keep_table(cut.withColumn("no", F.monotonically_increasing_id()), "pieces")
    items = kept.filter(F.col("length") < window).select("no", "length")
    done = kept.filter(F.col("length") >= window).select("no", (-1 - F.col("no")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    level, blocks = 0, None
    while blocks != 1:
        tokens = items.agg(F.sum("length")).first()[0]
        if not tokens:
            break
        blocks = max(1, -(-tokens // (window * bins)))
        solved = solve(items, blocks, window, seed, level, islands, epochs, generations)
        now = keep_table(placed(solved, window, level, blocks == 1), "placed")
        done = done.union(now.filter("NOT up").select("no", "sequence_id", "offset"))
        items, level = now.filter("up").select("no", "length"), level + 1
    return kept.join(done, "no").drop("no")


def pack_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_ids: bool = False) -> DataFrame:
    return pack(pieces(docs, vocab_path, id_col, text_col, window, with_ids=with_ids), window).withColumnRenamed("id", "doc_id")


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
