"""Exact Jaccard self-join on word n-grams, and the components of its links.

A document's set holds its distinct ``GRAM``-word shingles as 64-bit hashes.  Equal sets form a class; all
else runs on classes.

The join is size-aware.  Small sets enumerate subsets: two sets of n and m shingles link when they share
c(n, m) of them, so each set emits a key for every subset of every such size, and small sets that link share
a key.  Large sets scan inverted lists: shingles are ordered rarest first, and two sets that link share one
of the first n - ceil(0.85 n) + 1.  The boundary between small and large minimises the keys and list
entries, counted from the sizes of all documents.

The order needs the frequent shingles only.  All shingles of all documents are counted; the most frequent
ones, ``FREQUENT`` at most, go to every task, and the others come first by hash.

A group of near copies would make as many pairs as its square.  Components need fewer: in a round every list has a
hub, which all its other members are compared with, so a round makes no more pairs than there are list entries.  The
hub then leaves its list, for it has no pair left there; a list of two is done.  The components of all links found so
far are worked out, and the next round takes other hubs, in lists that still have several components.  When the pairs
left across components are few against the list entries, or a round has settled few of them, all pairs still across
components are compared, so no component is left apart.
That finds every component, not every link; where the links are to be counted, all pairs are compared at once.

A pair is compared by parity sketches first: a bitmap has the parity of the shingles that hash to each bit, so
two bitmaps differ in no more bits than the sets do in shingles.  What passes is verified on the full sets, made again
from the texts of those documents; a broadcast table of marks keeps most other texts out of that exchange.

Where all pairs of a list are compared, the join itself leaves out those that a short sketch rules out (the bitmap
folded to ``SHORT`` words), and a pair comes forth once for each stretch of common keys: not where the keys before
are the same too, for there it came forth already.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depotflow.llm.components import components
from depotflow.llm.tables import Scratch, release, row_key
from depotflow.llm.wordhash import NOT_SPACE, Slice, grams, mix, signed, slices, words

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
GRAM, PERCENT = 4, 85

#: Most frequent shingles that every task gets (12 bytes each), and the largest set that may count as small.
FREQUENT, SMALLEST_LARGE = 500_000, 24

#: Bytes of text whose shingles are counted in one group.
GROUP_BYTES = 4 << 20

#: Shingles that a task packs into blocks at a time.
BLOCK_SHINGLES = 1 << 20

#: Rounds with hubs at most, pairs for each list entry that are few enough to compare at once, and the share
#: of the pairs that a round must settle for another one to follow.
HUB_ROUNDS, FEW, HELP = 12, 0.5, 0.2

#: Settings of the runs inside: shuffle files go with the action that made them, small batches go to Python.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}

#: Words of a sketch that index entries carry into a join.
SHORT = 16

#: Rows that share a word of marks, and words of marks that every task may get (some 50 bytes each).
ROWS_A_WORD, MOST_WORDS = 4, 1_000_000

_COUNT_BITS = np.uint64(20)


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Shingles that sets of n and m must share to link."""
    return -(-percent * (n + m) // (100 + percent))


def first_shingles(n, percent: int = PERCENT):
    """Shingles of the prefix that a set of n must index."""
    return n + (-percent * n // 100) + 1


def subset_sizes(n: int, largest: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that a set of n shares with any linked set of ``largest`` or fewer."""
    partners = range(-(-percent * n // 100), min(100 * n // percent, largest) + 1)
    return sorted({least_overlap(n, m, percent) for m in partners})


def boundary(sizes: dict[int, int], scan: float, percent: int = PERCENT) -> int:
    """Largest size that counts as small, by cost.

    ``sizes`` has the sets by size as far as twice ``SMALLEST_LARGE`` (larger ones are large whatever the
    boundary), ``scan`` the average length of an inverted list.
    """

    def cost(x: int) -> float:
        light = sum(k * sum(comb(n, c) for c in subset_sizes(n, x, percent)) for n, k in sizes.items() if n <= x)
        heavy = sum(k * first_shingles(n, percent) * scan for n, k in sizes.items() if 100 * n >= percent * (x + 1))
        return light + heavy

    return min(range(SMALLEST_LARGE + 1), key=lambda x: (cost(x), x))


def shingles(part: Slice, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of a slice, by row and hash, and how many each row has."""
    found = words(part, NOT_SPACE)
    hashes, bounds = grams(found.hashes, found.bounds, gram)
    rows = np.repeat(np.arange(len(part)), np.diff(bounds))
    for n in range(1, gram):  # fewer words: the whole sequence
        short = np.flatnonzero(found.counts == n)
        if len(short):
            whole, starts = grams(found.hashes, found.bounds, n)
            hashes, rows = np.concatenate([hashes, whole[starts[short]]]), np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new], np.bincount(rows[new], minlength=len(part))


def _counted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal hashes."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def count_shingles(docs: DataFrame, groups: int, scratch: Scratch, gram: int = GRAM) -> tuple[DataFrame, dict[int, int], float]:
    """Shingles in more than one document (print, n), sets by size, and the mean length of a list.

    A task packs its shingles with their counts, many at a time, into one block for each group, so the shuffle
    moves eight bytes a shingle.  Group -1 has the sizes.
    """

    def blocks(prints: np.ndarray) -> pa.RecordBatch:
        prints, counts = np.unique(prints, return_counts=True)
        packed = prints << _COUNT_BITS | np.minimum(counts, (1 << 20) - 1).astype(np.uint64)
        of = (prints % np.uint64(groups)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        of, packed = of[order], packed[order]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        data = [packed[i:j].tobytes() for i, j in zip(first, [*first[1:], len(of)])]
        return pa.RecordBatch.from_arrays([pa.array(of[first], pa.int32()), pa.array(data, pa.binary())], ["at", "block"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(SMALLEST_LARGE * 2 + 1, dtype=np.int64)
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch.column(0)):
                _, hashes, n = shingles(part, gram)
                sizes += np.bincount(np.minimum(n, len(sizes) - 1), minlength=len(sizes))
                parts.append(hashes >> _COUNT_BITS)
                held += len(hashes)
                if held >= BLOCK_SHINGLES:
                    yield blocks(np.concatenate(parts))
                    parts, held = [], 0
        if held:
            yield blocks(np.concatenate(parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([sizes.tobytes()], pa.binary())], ["at", "block"]
        )

    def merge(table: pa.Table) -> pa.Table:
        at = table.column("at")[0].as_py()
        blocks = table.column("block").to_pylist()
        if at < 0:
            sizes = sum(np.frombuffer(b, dtype=np.int64) for b in blocks)
            prints, counts = np.arange(len(sizes)), sizes
        else:
            packed = np.frombuffer(b"".join(blocks), dtype=np.uint64)
            prints, counts = _counted(packed >> _COUNT_BITS, (packed & np.uint64((1 << 20) - 1)).astype(np.int64))
            more = counts > 1
            # The group's totals go along as print -1 (distinct) and -2 (all).
            totals = np.array([len(counts), counts.sum()], dtype=np.int64)
            prints, counts = signed(prints[more]), counts[more]
            prints, counts = np.concatenate([[-1, -2], prints]), np.concatenate([totals, counts])
        return pa.table({"at": pa.array(np.full(len(prints), at), pa.int32()), "print": pa.array(prints, pa.int64()), "n": pa.array(counts, pa.int64())})

    packed = docs.select("text").mapInArrow(pack, "at int, block binary")
    counts = scratch.put(packed.groupBy("at").applyInArrow(merge, "at int, print long, n long"), "counts")
    sizes = {r["print"]: r["n"] for r in counts.where("at = -1 and n > 0 and print > 0").collect()}
    totals = {r["print"]: r["n"] for r in counts.where("at >= 0 and print < 0").groupBy("print").agg(F.sum("n").alias("n")).collect()}
    scan = totals.get(-2, 0) / max(totals.get(-1, 0), 1)
    return counts.where("at >= 0 and print >= 0").select("print", "n"), sizes, max(scan, 1.0)


def most_frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Prints and counts of the most frequent shingles, ``most`` at most, sorted by print.

    Counts are told apart exactly up to 2 ** 16 and to a 64th of a power of two above.  Of those at the lowest
    count that not all fit, the ones with the smallest prints are taken, as many leading prints as fit whole.
    """
    top = F.lit(float(1 << 16))
    level = F.when(F.col("n") < top, F.col("n").cast("double")).otherwise(top + F.floor(64 * F.log2(F.col("n") / top)))
    counts = counts.withColumn("level", level.cast("long"))
    levels = counts.groupBy("level").agg(F.count("*").alias("prints")).collect()
    least, room, cut = 1 << 62, most, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        if r["prints"] > room:
            cut = r["level"]
            break
        room -= r["prints"]
        least = r["level"]
    taken = F.col("level") >= least
    if cut is not None and room:
        # Prints are hashes: their first 16 bits make blocks of about one size.
        block = F.shiftright("print", 64 - int(_COUNT_BITS) - 16)
        blocks = counts.where(F.col("level") == cut).groupBy(block.alias("block")).agg(F.count("*").alias("prints")).collect()
        until = 0
        for r in sorted(blocks, key=lambda r: r["block"]):
            room -= r["prints"]
            if room < 0:
                break
            until = r["block"] + 1
        taken |= (F.col("level") == cut) & (block < until)
    rows = counts.where(taken).select("print", "n").toArrow()
    prints, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("print", "n"))
    order = np.argsort(prints)
    return prints[order].astype(np.uint64), n[order]


def subset_keys(hashes: np.ndarray, largest: int, percent: int = PERCENT) -> list[int]:
    """A key for every subset that a small set can share with a linked small one."""
    mixed = mix(hashes)
    total = mixed.sum(dtype=np.uint64)
    out = []
    for c in subset_sizes(len(hashes), largest, percent):
        left_out = [mixed[list(x)].sum(dtype=np.uint64) for x in combinations(range(len(hashes)), len(hashes) - c)]
        out.append(mix(total - np.array(left_out, dtype=np.uint64) + np.uint64(c * 0xA24BAED4963EE407 % (1 << 64))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Words of a bitmap with eight bits or more for a shingle, one or more in sets of over 64 shingles: parities of the
    hashes by their last bits.  Few shingles share a bit as long as few tell two such sets apart.
    """
    least = 1 << int(len(hashes) - 1).bit_length()
    width = max(64, least, min(64 * SHORT, 8 * least))
    bits = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def index_sets(
    docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], largest_small: int, gram: int = GRAM, percent: int = PERCENT
) -> DataFrame:
    """Per document: n_shingles, the set's signature and parity sketch, and its index entries (key, place).

    The entries of rare shingles (and subsets) come first, ``n_rare`` of them; lists of those are short.
    Subset keys have the place -1.
    """
    prints, frequency = frequent
    kept = ["doc_id", "key_a", "key_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                rows, hashes, n = shingles(part, gram)
                short = hashes >> _COUNT_BITS
                counts = np.zeros(len(hashes), dtype=np.int64)
                if len(prints):
                    at = np.minimum(np.searchsorted(prints, short), len(prints) - 1)
                    counts = np.where(prints[at] == short, frequency[at], 0)
                order = np.lexsort((hashes, counts, rows))
                first = np.concatenate([[0], np.cumsum(n)])
                length = np.where(100 * n >= percent * (largest_small + 1), first_shingles(n, percent), 0)
                keys, places, rare, sketches = [], [], [], []
                for i in range(len(part)):
                    own = order[first[i] : first[i] + length[i]]
                    k, p = hashes[own], np.arange(length[i])
                    r = int((counts[own] == 0).sum())
                    if 0 < n[i] <= largest_small:
                        subsets = subset_keys(hashes[first[i] : first[i + 1]], largest_small, percent)
                        k, p = np.concatenate([subsets, k]), np.concatenate([np.full(len(subsets), -1), p])
                        r += len(subsets)
                    keys.append(k)
                    places.append(p)
                    rare.append(r)
                    sketches.append(parity(hashes[first[i] : first[i + 1]]))
                ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                sign = lambda x: signed(np.add.reduceat(np.append(x, np.uint64(0)), first[:-1]) * (n > 0).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(part.first, len(part)) for c in range(3)),
                        pa.array(n, pa.int64()),
                        pa.array(sign(mix(hashes)), pa.int64()),
                        pa.array(sign(mix(hashes ^ np.uint64(0x5851F42D4C957F2D))), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(signed(np.concatenate(keys)), pa.int64())),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places), pa.int32())),
                        pa.array(rare, pa.int32()),
                        pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    [*kept, "n_shingles", "set_a", "set_b", "keys", "places", "n_rare", "sketch"],
                )

    schema = "n_shingles long, set_a long, set_b long, keys array<long>, places array<int>, n_rare int, sketch array<long>"
    source = docs.select(F.col("doc_id").cast("long"), *row_key("doc_id", "text"), "text")
    return source.mapInArrow(run, f"doc_id long, key_a long, key_b long, {schema}")


def full_sets(texts: DataFrame, gram: int = GRAM) -> DataFrame:
    """(class, text) to (class, set as array of hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                _, hashes, n = shingles(part, gram)
                ends = pa.array(np.cumsum([0, *n]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(part)), pa.ListArray.from_arrays(ends, pa.array(signed(hashes), pa.int64()))],
                    ["class", "set"],
                )

    return texts.select("class", "text").mapInArrow(run, "class long, set array<long>")


def shared_entries(listed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Inverted lists (key, class, n, place) of classes that have another one of like size in their list.

    Sizes are alike where they do not rule out a link.  Lists of rare keys are short, so a window compares each size
    with the next ones in its list.  A frequent key may be in a third of all sets: its members are counted on the
    map side first, by bands of sizes (like ones are in the same or in adjacent bands), and the count is joined.
    """
    entry = F.posexplode(F.arrays_zip("index.keys", "index.places")).alias("at", "entry")
    entries = listed.select("class", F.col("n").cast("int"), "index.n_rare", entry).select(
        F.col("entry.keys").alias("key"), "class", "n", F.col("entry.places").alias("place"),
        (F.col("at") < F.col("n_rare")).alias("rare"),
    )
    by_size = Window.partitionBy("key").orderBy("n")
    rare = entries.where("rare").select("*", F.lag("n").over(by_size).alias("below"), F.lead("n").over(by_size).alias("above"))
    alike = (100 * F.col("below") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("above"))
    # Bands are a little wider than like sizes can be apart, whatever the rounding.
    band = F.floor(F.ln("n") / (log(100 / percent) + 1e-6))
    frequent = entries.where("not rare").withColumn("band", band)
    bands = frequent.groupBy("key", "band").agg(F.count("*").alias("members"))
    around = bands.select("key", F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1)))).alias("band"), "members")
    several = around.groupBy("key", "band").agg(F.sum("members").alias("members")).where("members > 1").drop("members")
    columns = ("key", "class", "n", "place")
    return rare.where(alike).select(*columns).unionByName(frequent.join(several, ["key", "band"]).select(*columns))


def _short(sketch):
    """The sketch folded to ``SHORT`` words; narrower ones stay."""
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(SHORT - 1)),
        lambda i: F.aggregate(
            F.filter(sketch, lambda _, at: at % SHORT == i), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y)
        ),
    )
    return F.when(F.size(sketch) > SHORT, parts).otherwise(sketch)


def _may_link(n, m, i, j, percent: int = PERCENT):
    """Sizes, and places of the first common shingle, do not rule out a link.  Places of -1 rule out nothing."""
    need = F.ceil(percent * (n + m) / F.lit(100.0 + percent) - 1e-9)
    rest = F.when((i >= 0) & (j >= 0), F.least(n - i, m - j)).otherwise(F.least(n, m))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (rest >= need)


def _may_differ_so(one, other, n, m, percent: int = PERCENT):
    """The sketches do not rule out a link.  Widths differ by a factor of two at most; the wider is folded."""
    xor = lambda x, y: x.bitwiseXOR(y)
    least = F.least(F.size(one), F.size(other))

    def folded(sketch):
        halves = F.zip_with(F.slice(sketch, 1, least), F.slice(sketch, least + 1, least), xor)
        return F.when(F.size(sketch) > least, halves).otherwise(sketch)

    bits = F.aggregate(F.zip_with(folded(one), folded(other), lambda x, y: F.bit_count(xor(x, y))), F.lit(0), lambda s, x: s + x)
    need = F.ceil(percent * (n + m) / F.lit(100.0 + percent) - 1e-9)
    return bits <= n + m - 2 * need


def texts_of(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``texts`` joined with ``rows`` by key_a and key_b, each row once.

    A table of marks, a bit for every row, goes to all tasks, so few texts but those asked for are shuffled.
    """
    n_words = max(1, rows.count() // ROWS_A_WORD)
    if n_words <= MOST_WORDS:
        word, bit = F.pmod(F.col("key_a"), F.lit(n_words)).alias("word"), F.expr("shiftleft(1L, cast(pmod(key_b, 64) as int))")
        marks = rows.groupBy(word).agg(F.bit_or(bit).alias("marks"))
        texts = texts.select("*", word).join(F.broadcast(marks), "word")
        texts = texts.where(F.col("marks").bitwiseAND(bit) != 0).select("key_a", "key_b", "text")
    # Repeated rows of a document give equal sets, one is enough.
    return texts.join(rows, ["key_a", "key_b"]).dropDuplicates(["key_a", "key_b"])


def verified(
    pairs: DataFrame, members: DataFrame, texts: DataFrame, scratch: Scratch, name: str, gram: int = GRAM, percent: int = PERCENT
) -> DataFrame:
    """Those of the pairs (a, b) whose sets link.  ``texts`` has key_a, key_b and text of all documents."""

    def side(end: str):
        return members.select(F.col("class").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in ("n", "sketch", "row_a", "row_b")))

    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.where(_may_differ_so(F.col("sketch_a"), F.col("sketch_b"), F.col("n_a"), F.col("n_b"), percent))
    near = scratch.put(near.select("a", "b", "row_a_a", "row_b_a", "row_a_b", "row_b_b"), f"near-{name}")
    ends = [near.select(F.col(e).alias("class"), F.col(f"row_a_{e}").alias("key_a"), F.col(f"row_b_{e}").alias("key_b")) for e in "ab"]
    rows = scratch.put(ends[0].unionByName(ends[1]).distinct(), f"rows-{name}")
    sets = scratch.put(full_sets(texts_of(rows, texts), gram), f"full-{name}")
    one = sets.select(F.col("class").alias("a"), F.col("set").alias("one"))
    other = sets.select(F.col("class").alias("b"), F.col("set").alias("other"))
    both = F.size(F.array_intersect("one", "other"))
    joined = near.select("a", "b").join(one, "a").join(other, "b")
    joined = joined.where(100 * both >= percent * (F.size("one") + F.size("other") - both))
    links = scratch.put(joined.select("a", "b"), f"links-{name}")
    for what in ("near", "rows", "full"):
        scratch.drop(f"{what}-{name}")
    return links


def list_entries(members: DataFrame) -> DataFrame:
    """List entries (key, class, n, place, last) of ``members``: ``last`` is the key before it in its set's order."""
    placed = F.array_sort(F.transform("lists", lambda x: F.struct(x["place"].alias("place"), x["key"].alias("key"))))
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice("placed.key", 1, F.size("placed") - 1))
    both = F.arrays_zip(F.col("placed").alias("own"), before.alias("last"))
    entries = members.withColumn("placed", placed).select("class", "n", F.explode(both).alias("at"))
    return entries.select("at.own.key", "class", "n", "at.own.place", "at.last")


def links_of(
    members: DataFrame, texts: DataFrame, scratch: Scratch, every: bool = False, gram: int = GRAM, percent: int = PERCENT
) -> tuple[DataFrame | None, DataFrame | None]:
    """Links (a, b) of classes, enough for their components, or ``every`` one, once each; and those components
    (``components``).  Both are None without any link.

    ``members`` has the classes that share lists: class, n, sketch, row_a, row_b, and lists (key, place).
    """
    links, found, turn, before = None, None, 0, float("inf")
    n_entries = members.agg(F.sum(F.size("lists"))).first()[0] or 0
    entries = list_entries(members)
    while n_entries:
        named = entries.withColumn("component", F.col("class"))
        if found is not None:
            known = entries.join(found.withColumnRenamed("node", "class"), "class", "left")
            named = known.withColumn("component", F.coalesce("component", "class"))
        # Pairs across components, from counts alone, and a hub of each list: the set that has fewest shingles before
        # the key, so it is near to most others; in later rounds any.
        order = F.xxhash64("class", F.lit(turn)) if turn else F.col("place")
        hub = F.min(F.struct(order.alias("order"), "class", "n", "place", "component")).alias("hub")
        shares = named.groupBy("key", "component").agg(F.count("*").cast("double").alias("n"), hub)
        square = (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2
        across = shares.groupBy("key").agg(square.alias("pairs"), F.min("hub").alias("hub")).where("pairs > 0")
        across = scratch.put(across, f"across-{turn}")
        left = across.agg(F.sum("pairs")).first()[0] or 0.0
        if not left:
            scratch.drop(f"entries-{turn - 1}")
            break
        last = every or left <= FEW * n_entries or turn >= HUB_ROUNDS or left > (1 - HELP) * before
        before = left
        if last:
            # Every entry left, with its set's short sketch.
            listed = named.join(across.select("key"), "key", "left_semi")
            listed = listed.join(members.select("class", _short(F.col("sketch")).alias("short")), "class")
            kept = ("class", "n", "place", "component", "last", "short")
            one = listed.select("key", *(F.col(c).alias(f"{c}_a") for c in kept))
            other = listed.select("key", *(F.col(c).alias(f"{c}_b") for c in kept))
            pairs = one.join(other, "key").where(F.col("component_a") < F.col("component_b"))
            pairs = pairs.where(F.coalesce(F.col("last_a") != F.col("last_b"), F.lit(True)))
            pairs = pairs.where(_may_link(F.col("n_a"), F.col("n_b"), F.col("place_a"), F.col("place_b"), percent))
            pairs = pairs.where(_may_differ_so(F.col("short_a"), F.col("short_b"), F.col("n_a"), F.col("n_b"), percent))
            pairs = pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
        else:
            # The entries but the hubs', each with the hub it is to be compared with, if any.
            with_hub = named.join(across.select("key", "hub"), "key").where(F.col("class") != F.col("hub.class"))
            may = _may_link(F.col("n"), F.col("hub.n"), F.col("place"), F.col("hub.place"), percent)
            to = F.when((F.col("component") != F.col("hub.component")) & may, F.col("hub.class"))
            rest = scratch.put(with_hub.select("key", "class", "n", "place", "last", to.alias("to")), f"entries-{turn}")
            pairs = rest.where("to is not null").select(F.col("class").alias("a"), F.col("to").alias("b"))
            entries = rest.drop("to")
        pairs = scratch.put(pairs.distinct(), f"pairs-{turn}")
        scratch.drop(f"entries-{turn - 1}")
        new = verified(pairs, members, texts, scratch, str(turn), gram, percent)
        for what in ("pairs", "across"):
            scratch.drop(f"{what}-{turn}")
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            found = components(links, scratch, f"round-{turn}")
        if last:
            break
        release(members.sparkSession)
        turn += 1
    return links, found


def near_copies(
    docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, count_links: bool = False, keyed: bool = False
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, linked (its set links with a different one).

    ``keyed`` appends the row's key_a and key_b (``row_key("doc_id", "text")``), for decisions on rows whose ids may
    be null or shared.

    With ``count_links`` every pair of different sets that may link is verified, and ``n_links`` is appended: the
    number of different sets that the document's set links with.  Without, only as many links are looked for as
    the components need.  ``percent`` is 50 at least (sketches of linked sets differ by one width).

    ``docs`` has doc_id and text; other columns are ignored.  Null texts and texts without words have no
    shingles and link with nothing, not even with each other: their component is their own doc_id.  Repeated
    rows give a row each.  A null doc_id takes part; a component of such rows alone has a null id.
    """
    if gram < 1 or not 50 <= percent <= 100:
        raise ValueError("gram must be 1 or more, percent from 50 to 100")
    spark = docs.sparkSession
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    scratch = Scratch(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    release(spark)
    try:
        text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        counts, sizes, scan = count_shingles(docs, max(64, text_bytes // GROUP_BYTES), scratch, gram)
        small = boundary(sizes, scan) if percent == PERCENT else boundary(sizes, scan, percent)
        indexed = scratch.put(index_sets(docs, most_frequent(counts), small, gram, percent), "indexed")
        scratch.drop("counts")
        release(spark)
        sets = scratch.put(indexed.select("doc_id", "key_a", "key_b", "n_shingles", "set_a", "set_b"), "sets")
        classes = (
            indexed.where("n_shingles > 0")
            .groupBy("set_a", "set_b")
            .agg(
                F.min("doc_id").alias("first_id"),
                F.min(F.struct("key_a", "key_b")).alias("row"),
                F.first("n_shingles").alias("n"),
                F.first("sketch").alias("sketch"),
                F.first(F.struct("keys", "places", "n_rare")).alias("index"),
            )
        )
        # The ids are fixed once the table is written.
        listed = scratch.put(classes.withColumn("class", F.monotonically_increasing_id()), "listed")
        scratch.drop("indexed")
        lists = shared_entries(listed, percent).groupBy("class").agg(F.collect_list(F.struct("key", "place")).alias("lists"))
        members = lists.join(
            listed.select(
                "class", "n", "sketch", F.col("row.key_a").alias("row_a"), F.col("row.key_b").alias("row_b")
            ),
            "class",
        )
        members = scratch.put(members.withColumn("n", F.col("n").cast("int")), "members")
        classes = scratch.put(listed.select("class", "set_a", "set_b", "first_id"), "classes")
        scratch.drop("listed")
        texts = docs.select(*row_key("doc_id", "text"), "text")
        links, found = links_of(members, texts, scratch, count_links, gram, percent)
        own = classes.select("class", "set_a", "set_b", "first_id")
        if found is None:
            named = own.select("set_a", "set_b", F.col("first_id").alias("component_id"), F.lit(False).alias("linked"), F.lit(0).cast("long").alias("n_links"))
        else:
            joined = own.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
                "group", F.coalesce("component", "class")
            )
            smallest = joined.where("component is not null").groupBy("component").agg(F.min("first_id").alias("least"))
            ends = links.select(F.col("a").alias("class")).unionByName(links.select(F.col("b").alias("class")))
            joined = joined.join(ends.groupBy("class").agg(F.count("*").alias("n_links")), "class", "left")
            named = joined.join(smallest, "component", "left").select(
                "set_a", "set_b", F.coalesce("least", "first_id").alias("component_id"), F.col("component").isNotNull().alias("linked"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            )
        named = scratch.put(named, "named")
        scratch.drop("members")
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    whole = sets.join(named, ["set_a", "set_b"], "left")
    return whole.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("linked", F.lit(False)).alias("linked"),
        *([F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] if count_links else []),
        *(["key_a", "key_b"] if keyed else []),
    )
