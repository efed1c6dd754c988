"""SimHash near-duplicate groups by multi-index hashing.

A fingerprint has 64 bits in two segments of 32. Two fingerprints that differ in at most three
bits differ in at most one bit of some segment, so each fingerprint looks up the ball of radius
one around each of its segments in tables keyed by the segment, and the complete distance of
what it finds is checked. A pair one bit apart in a segment is found from its side with the
smaller value only, so a ball has 1 to 33 keys.

Everything runs on distinct fingerprints: thousands of copies are one row in the index. Links
become components by alternating star contractions (a few shuffles of the links), and the
documents take their component from their fingerprint.

Defined cases: null or wordless text has fingerprint zero and is linked like any other; fewer
words than the shingle width make one shingle of the whole sequence; repeated rows are copies of
each other; a null id never becomes a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from posterion.llm import common
from posterion.llm.common import fresh, renamed, staged

SEED = 42
SEGMENT = 32
# segments of a wide fingerprint by their bits: so many that a pair at 0.8, where a bit differs with probability 0.15, meets in one
# of them with probability 0.9999
PLACES = {20: 29, 21: 33, 22: 39, 23: 45, 24: 51, 25: 59, 26: 68, 27: 80, 28: 92, 29: 106, 30: 124, 31: 142}
BALL, SHORT = 4, 30         # bits of a segment that a ball turns over; three times as many for texts of at most SHORT shingles
CHECK, APART = 2, 0.35      # words of the fingerprint that pairs are checked by, and the share of their bits beyond which no text is read
PREFIX, CELL_BITS = 2, 18   # bits of a segment that name its cell, and the number of texts (as a power of 2) from which they are more
CROWD = 64                  # rows of a bucket up to which all its pairs are checked by their check words
MIX = np.random.default_rng(SEED).integers(0, 1 << 64, max(w * n for w, n in PLACES.items()) // 64 + 1 + CHECK, np.uint64)
PAIRED = 8                  # rows of a group up to which all its likely pairs are compared
SALTS = 256


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(words[i:i + width]), SEED) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, name: str, text: str = "text", width: int = 3) -> DataFrame:
    """The table with the fingerprint of each text in a new column."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py(), width) for t in texts), pa.int64())

    return docs.withColumn(name, of(F.col(f"`{text}`")))


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs u < v of distinct fingerprints at most `distance` (up to 3) bits apart, each once."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one answer distances of at most 3")
    ones = (1 << SEGMENT) - 1
    fp = prints.select("fp").distinct()
    high, low = F.shiftrightunsigned("fp", SEGMENT), F.col("fp").bitwiseAND(F.lit(ones))
    segments = fp.select("fp", F.posexplode(F.array(high, low)).alias("segment", "key"))
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(SEGMENT - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)),
                     lambda b: F.col("key").bitwiseAND(b) == 0)
    ball = F.concat(F.array("key"), F.transform(flips, lambda b: F.col("key").bitwiseOR(b)))
    probes = segments.select(F.col("fp").alias("p"), "segment", F.col("key").alias("own"), F.explode(ball).alias("key"))
    found = probes.join(segments, ["segment", "key"]).filter(
        (F.bit_count(F.col("p").bitwiseXOR(F.col("fp"))) <= distance)
        & ((F.col("own") != F.col("key")) | (F.col("p") < F.col("fp"))))
    return found.select(F.least("p", "fp").alias("u"), F.greatest("p", "fp").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of all nodes that have an edge.

    Large-star and small-star steps alternate until the edges stay the same; each keeps the
    components and at most the number of edges, and stars of depth one remain. They settle in a
    number of steps that grows with the logarithm of the longest chain.
    """
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = staged(edges.select("u", "v"), "edges")
    before = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v")
        up = large.filter("u < v").distinct().select(F.col("v").alias("u"), F.col("u").alias("v"))    # from a node to smaller ones
        small = up.join(smallest(up), "u").select("u", "v", "m")
        edges = staged(small.select(F.col("m").alias("u"), "v").union(small.select(F.col("m").alias("u"), F.col("u").alias("v")))
                       .filter("u < v").distinct(), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def grouped(prints: DataFrame, distance: int = 3) -> DataFrame:
    """fp, root: the group of each distinct fingerprint."""
    comp = components(links(prints, distance))
    return prints.select("fp").distinct().join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id (smallest id reachable)."""
    prints = staged(with_fingerprint(renamed(docs, {"doc_id": id_col, "text": text}), "fp", width=width).select("doc_id", "fp"), "prints")
    groups = grouped(prints, distance)
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = staged(groups.join(firsts, "fp"), "groups")
    roots = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(named.join(roots, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


# -- near copies by the words themselves ------------------------------------------

def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    n = max(1, len(words) - width + 1)
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), SEED) for i in range(n)), np.uint64, n)


def resemblance(a: str | None, b: str | None, width: int = 5) -> float:
    """Shared part of all distinct shingles of two texts, by the words themselves."""
    x, y = ({b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} for w in (_words(a), _words(b)))
    return len(x & y) / len(x | y)


def layout(rows: int) -> tuple[int, int]:
    """(segments, bits of a segment) for so many texts: 23 bits up to 16 million of them, so that a text has as many
    keys however many there are, and beyond one bit less than their number, so that a bucket holds some ten unlike texts."""
    width = min(max(rows.bit_length() - 1, 23), max(PLACES))
    return PLACES[width], width


def bit_counts(hashes: np.ndarray, words: int) -> np.ndarray:
    """How many shingles set each bit of a fingerprint of so many 64-bit words, each a mix of the shingle's hash."""
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), 255):           # so many fit a byte
        x = hashes[at:at + 255, None] ^ MIX[:words]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return ones


def wide_print(hashes: np.ndarray, segments: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The wide fingerprint of distinct shingles: its segments and its CHECK words.

    The low half of a segment's number are its bits, the high half marks those whose votes were closest."""
    n = len(hashes)
    ones = bit_counts(hashes, -(-segments * width // 64) + CHECK)
    votes = 2 * ones - n
    place = np.int64(1) << np.arange(width)
    part = votes[:segments * width].reshape(segments, width)
    close = np.argsort(np.abs(part), axis=1, kind="stable")[:, :BALL if n > SHORT else 3 * BALL]
    return (part > 0) @ place | place[close].sum(axis=1) << 32, np.packbits(votes[-64 * CHECK:] > 0, bitorder="little").view(np.int64)


def ball(prints: pa.Array) -> pa.Array:
    """The keys of each row's segments: a segment's number and its bits, as they are and with one marked bit turned over."""
    flat, lengths = prints.flatten().to_numpy(zero_copy_only=False).astype(np.int64), prints.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    own = (np.arange(len(flat)) - np.repeat(starts[:-1], lengths)) << 32 | flat & 0xFFFFFFFF
    turned = np.concatenate([[0], np.int64(1) << np.arange(31)])
    chosen = np.concatenate([np.ones((len(flat), 1), bool), (flat[:, None] >> np.arange(32, 63) & 1).astype(bool)], axis=1)
    cell, which = np.nonzero(chosen)
    ends = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), pa.array(own[cell] ^ turned[which], pa.int64()))


def cells(prints: pa.Array, width: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, segment) of each row's segments: a cell is a segment's number and the first `prefix` of its bits, and
    a segment goes to each cell that a key of its ball is in, once."""
    flat, lengths = prints.flatten().to_numpy(zero_copy_only=False).astype(np.int64), prints.value_lengths().to_numpy(zero_copy_only=False)
    keys = ball(pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1), pa.int32()), pa.array(flat, pa.int64())))
    at = np.repeat(np.arange(len(flat)), keys.value_lengths().to_numpy(zero_copy_only=False))
    number = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    own = keys.flatten().to_numpy(zero_copy_only=False) >> width - prefix
    pairs = np.unique(at << prefix | own)
    at = pairs >> prefix
    return np.repeat(np.arange(len(lengths)), lengths)[at], number[at] << prefix | pairs & (1 << prefix) - 1, flat[at]


def _dealt(width: int, prefix: int):
    """Rows (row, n, print, check) become one row for each cell of their segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                at, cell, segment = cells(part.column("print"), width, prefix)
                words = part.column("check").flatten().to_numpy(zero_copy_only=False).reshape(-1, CHECK)[at]
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cell), "row": part.column("row").take(pa.array(at)), "n": part.column("n").take(pa.array(at)),
                                                  "segment": pa.array(segment)} | {f"c{i}": pa.array(words[:, i]) for i in range(CHECK)})
    return run


def joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The group of each of so many rows: the smallest row that the pairs (a, b) lead to."""
    label = np.arange(size)
    while (label[a] != label[b]).any():
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]
    return label


def _meeting(width: int, prefix: int, similarity: float):
    """What a cell's rows have to be compared with: (x, y, pair, member).

    A pair of a bucket goes on when its sizes and check words allow it; the rows of a bucket of more than CROWD count as
    met. Pairs that go on make groups. In a group of up to PAIRED rows they are compared as they are; the rows of a
    larger one are members of y, its row nearest to the majority of the check words, and are compared with that one."""
    def run(group: pa.Table) -> pa.Table:
        prints = group.column("segment").to_numpy()
        row, n = group.column("row").to_numpy(), group.column("n").to_numpy().astype(np.float64)
        check = np.stack([group.column(f"c{i}").to_numpy() for i in range(CHECK)], axis=1).view(np.uint64)
        own = group.column("cell")[0].as_py() & (1 << prefix) - 1

        def close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return (np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y]) - 1e-6) & (np.bitwise_count(check[x] ^ check[y]).sum(axis=1, dtype=np.int64) <= int(APART * 64 * CHECK))

        lists = ball(pa.ListArray.from_arrays(pa.array(np.arange(len(prints) + 1), pa.int32()), pa.array(prints, pa.int64())))
        key, at = lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(prints)), lists.value_lengths().to_numpy(zero_copy_only=False))
        here = key >> width - prefix == own
        key, at = key[here], at[here]
        order = np.lexsort((row[at], key))
        key, at = key[order], at[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.repeat(np.diff(np.concatenate([start, [len(key)]])), np.diff(np.concatenate([start, [len(key)]])))
        first = np.repeat(start, many[start])
        left = np.where(many > CROWD, 0, first + many - np.arange(len(key)) - 1)        # rows that follow in the same bucket

        found, live = [np.empty((0, 2), np.int64)], np.flatnonzero(left)
        for step in range(1, CROWD):
            live = live[left[live] >= step]
            x, y = at[live], at[live + step]
            found.append(np.stack([x, y], axis=1)[close(x, y)])
        pairs = np.unique(np.concatenate(found), axis=0)
        crowd = many > CROWD
        label = joined(np.concatenate([pairs[:, 0], at[first[crowd]]]), np.concatenate([pairs[:, 1], at[crowd]]), len(prints))
        large = np.bincount(label, minlength=len(prints)) > PAIRED

        members = np.flatnonzero(large[label])
        members = members[np.argsort(label[members], kind="stable")]
        heads = np.empty(len(members), np.int64)
        for rows in np.split(np.arange(len(members)), np.flatnonzero(np.diff(label[members])) + 1):
            words = check[members[rows]]
            votes = np.unpackbits(words.view(np.uint8).reshape(-1, 8 * CHECK), axis=1).sum(axis=0, dtype=np.int64)
            apart = np.bitwise_count(words ^ np.packbits(2 * votes > len(rows)).view(np.uint64)).sum(axis=1, dtype=np.int64)
            heads[rows] = members[rows][np.lexsort((row[members[rows]], apart))[:1]]
        star = close(members, heads) & (members != heads)
        few = pairs[~large[label[pairs[:, 0]]]]
        return pa.table({"x": row[np.concatenate([members, few[:, 1]])], "y": row[np.concatenate([heads, few[:, 0]])],
                         "pair": np.concatenate([star, np.ones(len(few), bool)]), "member": np.arange(len(members) + len(few)) < len(members)})
    return run


def _signed(docs: DataFrame, name: str, text: str, width: int, segments: int, bits: int) -> DataFrame:
    """The table with struct(digest of the words, n distinct shingles, segments of the wide fingerprint, its check words) in a new column."""
    kind = pa.struct([("digest", pa.binary()), ("n", pa.int32()), ("print", pa.list_(pa.int64())), ("check", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<digest:binary,n:int,print:array<bigint>,check:array<bigint>>")
    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            words = _words(t.as_py())
            hashes = np.unique(_hashes(words, width)) if words else np.empty(0, np.uint64)
            own, check = wide_print(hashes, segments, bits) if words else ([], [])
            rows.append({"digest": xxhash.xxh3_128_digest(b" ".join(words)), "n": len(hashes), "print": own, "check": check})
        return pa.array(rows, kind)

    return docs.withColumn(name, of(F.col(f"`{text}`")))


def sketch(values: np.ndarray) -> list[int]:
    """The low byte of each value, eight to a long."""
    return values.astype(np.uint8).view(np.int64).tolist()


def agreeing(a: Column, b: Column, places: int = 64) -> Column:
    """How many of the bytes of two sketches are equal."""
    def unequal(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for step in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        return F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    total = unequal(0)
    for i in range(1, places // 8):
        total = total + unequal(i)
    return F.lit(places) - total


def _alike(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (x, y) whose texts (row, text) resemble each other, checked by their words.

    A row y of many pairs is dealt over SALTS keys."""
    @F.arrow_udf("boolean")
    def close(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([resemblance(s.as_py(), t.as_py(), width) >= similarity for s, t in zip(a, b)], pa.bool_())

    dealt = common.sized(pairs.withColumn("salt", F.pmod(F.xxhash64("x"), F.lit(SALTS))))
    left = texts.join(dealt, F.col("row") == F.col("x")).select("x", "y", "salt", F.col("text").alias("a"))
    meets = common.sized(staged(dealt.select("y", "salt").distinct(), "meets"))
    right = texts.join(meets, F.col("row") == F.col("y")).select("y", "salt", F.col("text").alias("b"))
    return left.join(right, ["y", "salt"]).filter(close("a", "b")).select("x", "y")


def _rarest(shingles: DataFrame, similarity: float) -> DataFrame:
    """row, n, gram, place: the rarest shingles of each row, n - ceil(similarity * n) + 1 of them in one order for
    all, so that two rows of the wanted resemblance have one of them in common."""
    often = shingles.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = shingles.join(often, "gram").groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g"))
    keep = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1
    return ranked.select("row", "n", F.posexplode(F.slice("g", F.lit(1), keep.cast("int"))).alias("place", "g")).select("row", "n", "place", F.col("g.gram").alias("gram"))


def _missed(near: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Pairs of rows of different groups that may resemble each other: exact, by the prefix filter on rarest shingles.

    `near` holds row, root (its group so far) and minor: at least one row of a pair is minor. Two sets that share
    what the resemblance asks for have it behind their first common shingle, which most matches fail."""
    @F.arrow_udf("array<bigint>")
    def grams(t: pa.Array) -> pa.Array:
        return pa.array([np.unique(_hashes(_words(s.as_py()), width)).view(np.int64) for s in t], pa.list_(pa.int64()))

    rows = texts.join(near.select("row"), "row").select("row", grams("text").alias("g"))
    prefix = staged(_rarest(rows.select("row", F.size("g").alias("n"), F.explode("g").alias("gram")), similarity).join(near, "row"), "rarest")
    one = prefix.filter("minor").select(F.col("row").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("place").alias("px"), "gram")
    share = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("nx") + F.col("n")) - 1e-9)
    both = one.join(prefix, (one["gram"] == prefix["gram"]) & (F.col("rx") != F.col("root")) & sized(F.col("nx"), F.col("n"), similarity)
                    & (F.least(F.col("nx") - F.col("px"), F.col("n") - F.col("place")) >= share))
    return both.select(F.least("x", "row").alias("x"), F.greatest("x", "row").alias("y")).distinct()


def sized(a: Column, b: Column, similarity: float) -> Column:
    """Sets of these sizes can resemble each other."""
    return F.least(a, b) >= F.lit(similarity) * F.greatest(a, b) - 1e-6


def alike(nodes: DataFrame, texts: DataFrame, known: int, bits: int, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The groups of nodes (first struct(a, b, c: row), n, print, check): node, root of all rows that have a link.

    Multi-index hashing of wide fingerprints: each node is entered under its segments and under the balls around
    them, so two nodes meet where they are at most two bits apart by bits that were close. A segment is dealt once to
    each cell of its ball, with check words, and its keys are met inside the cell: pairs of unlike texts end there.
    Likely pairs make the cell's groups. In one of up to PAIRED nodes they are all compared; in a larger one its central
    node with all others, so a large group of near copies costs a few comparisons a node. The links so far make roots.
    In a large group that still holds several, the rows outside its largest one look for partners among the others,
    by the prefix filter on rarest shingles, which loses no pair. So two alike nodes of one bucket end under one root,
    whichever pairs were compared.

    Only texts of pairs that passed, and of large groups, are looked at again, in a table of their own. They get there without a
    shuffle while their row numbers are few enough to broadcast (`common.sized`); beyond, all texts are dealt once."""
    prefix = max(PREFIX, known.bit_length() - CELL_BITS)
    flat = nodes.filter("n > 0").select(F.col("first.c").alias("row"), "n", "print", "check")
    entered = flat.mapInArrow(_dealt(bits, prefix), "cell long, row long, n int, segment long, " + ", ".join(f"c{i} long" for i in range(CHECK)))
    met = entered.groupBy("cell").applyInArrow(_meeting(bits, prefix, similarity), "x long, y long, pair boolean, member boolean")
    met = staged(met.groupBy("x", "y").agg(F.bool_or("pair").alias("pair"), F.bool_or("member").alias("member")), "met")
    pairs = met.filter("pair").select("x", "y")
    large = met.filter("member").select(F.col("y").alias("key"), F.col("x").alias("row"))
    rows = staged(met.select(F.col("x").alias("row")).union(met.select(F.col("y").alias("row"))).distinct(), "rows")
    busy = staged(texts.join(common.sized(rows), "row", "left_semi"), "busy")
    linked = staged(_alike(pairs, busy, width, similarity), "alike")

    root = components(_edges(linked))
    placed = staged(large.join(root, F.col("row") == F.col("node"), "left").select("key", "row", F.coalesce("root", "row").alias("root")), "placed")
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("rows"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("groups"), F.max(F.struct("rows", "root"))["root"].alias("top")).filter("groups > 1")
    near = placed.join(mixed, "key").groupBy("row", "root").agg(F.max(F.col("root") != F.col("top")).alias("minor"))
    more = staged(_missed(staged(near, "near"), busy, width, similarity), "pairs")
    return components(_edges(linked.unionByName(_alike(more, busy, width, similarity))))


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents without near copies: texts that share `similarity` of their `width`-word
    shingles or more are linked, and of each linked group the one with the smallest id stays (of
    repeated rows with that id one; rows without id come last).

    A fingerprint of 64 bits differs in about 10 bits at a resemblance of 0.8, beyond any radius that balls around
    its segments can search without comparing most texts with most others. So the fingerprints of this stage are wider:
    a majority bit is again a vote of all shingles, and there are as many segments as `PLACES` says for the bits of
    `layout`. Balls turn over the bits whose votes were closest, which are those that differ. A pair
    at 0.8 is missed with probability 0.0001 (0.0003 where both have five shingles or less), a closer one with less. Distinct texts only,
    and the pairs are checked exactly.
    """
    known = docs.count()
    segments, bits = layout(known)
    sign, row = fresh(docs, "__sign"), fresh(docs, "__row")
    marked = staged(_signed(docs, sign, text, width, segments, bits).withColumn(row, F.monotonically_increasing_id()), "marked")
    order = F.struct(F.col(f"`{id_col}`").isNull().alias("a"), F.col(f"`{id_col}`").alias("b"), F.col(row).alias("c"))
    rows = marked.select(F.col(sign)["digest"].alias("digest"), F.struct(order.alias("first"), *(F.col(sign)[c].alias(c) for c in ("n", "print", "check"))).alias("s"))
    nodes = staged(rows.groupBy("digest").agg(F.min("s").alias("s")).select("s.*"), "nodes")
    texts = marked.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text"))
    winners = nodes.join(alike(nodes, texts, known, bits, width, similarity), F.col("first.c") == F.col("node"), "left").groupBy(F.coalesce("root", "first.c").alias("root")).agg(F.min("first").alias("first"))
    # those that go are fewer than those that stay
    losers = marked.select(row).join(winners.select(F.col("first.c").alias(row)), row, "left_anti")
    return marked.join(common.sized(staged(losers, "losers")), row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
