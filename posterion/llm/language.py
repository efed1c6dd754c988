"""Language identification by prediction by partial matching over bytes.

For each language a context tree of the orders 0 to ORDER counts which byte followed which
context. A byte costs its code length at the longest context that has seen it, after the escape
costs of the longer contexts that have not (escape method C: distinct / (total + distinct)), and
1/256 below order 0. The statistics are frozen: scoring changes nothing. A text's language is the
one with the shortest code for all its bytes; the score is the share of 2^-length it gets.

The trees come from a bounded sample of labelled documents (`per_language` whole texts of each
language, by the smallest hash of their id); counting runs in tasks, and only the counts reach
the driver. Costs of all contexts seen in any language are resolved once into one table; others
are resolved in the task by the same rule.

Defined cases: null text or text without a letter is `und` with score 0, as is everything when
there is nothing to learn from; ties go to the language that sorts first; labels are never read
at prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import kept

ORDER = 4
PER_LANGUAGE = 240
PAD = b"\n" * ORDER
SEED = 5
CHUNK = 1 << 20
SLOTS = 20                          # bits of the lookup's slot number


def _codes(data: np.ndarray, order: int) -> np.ndarray:
    """The context of `order` bytes and the byte itself, at every place after the padding, as one number."""
    out = np.zeros(max(0, len(data) - ORDER), np.uint64)
    for back in range(order, -1, -1):
        out = (out << np.uint64(8)) | data[ORDER - back:len(data) - back].astype(np.uint64)
    return out | np.uint64((order + 1) << 56)           # the order keeps codes of different lengths apart


def _count(batches):
    held: dict[str, list[np.ndarray]] = {}

    def counted(lang):
        codes, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))],
                                          names=["lang", "code", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = np.frombuffer(PAD + text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
            held.setdefault(lang, []).extend(_codes(data, o) for o in range(ORDER + 1))
        for lang in [x for x, a in held.items() if sum(map(len, a)) > 20 * CHUNK]:
            yield counted(lang)
    for lang in list(held):
        yield counted(lang)


class _Find:
    """Places of numbers in a sorted array: two hashed slots, then binary search for the rest."""
    MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.slots = []
        rest = np.arange(len(keys))
        for m in self.MULTIPLIERS:
            slot = np.zeros(1 << SLOTS, np.int32)
            at = (keys[rest] * m) >> np.uint64(64 - SLOTS)
            slot[at] = rest
            self.slots.append(slot)
            rest = rest[slot[at] != rest]
        self.rest = rest

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.slots[0][(wanted * self.MULTIPLIERS[0]) >> np.uint64(64 - SLOTS)]
        found = self.keys[place] == wanted
        miss = np.flatnonzero(~found)
        again = self.slots[1][(wanted[miss] * self.MULTIPLIERS[1]) >> np.uint64(64 - SLOTS)]
        place[miss], found[miss] = again, self.keys[again] == wanted[miss]
        if len(self.rest):
            miss = np.flatnonzero(~found)
            left = self.keys[self.rest]
            at = np.minimum(np.searchsorted(left, wanted[miss]), len(left) - 1)
            place[miss], found[miss] = self.rest[at], left[at] == wanted[miss]
        return place, found


class Trees:
    """Frozen context trees of all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(counts)
        self.tables = []                    # per language: seen codes and their bits, contexts and their escape bits
        for lang in self.languages:
            codes, n = counts[lang]
            order = np.argsort(codes)
            codes, n = codes[order], n[order].astype(np.float64)
            contexts, at, distinct = np.unique(self._context(codes), return_inverse=True, return_counts=True)
            total = np.bincount(at, n)
            self.tables.append((codes, (np.log2(total + distinct)[at] - np.log2(n)).astype(np.float32),
                                contexts, (np.log2(total + distinct) - np.log2(distinct)).astype(np.float32)))
        full = [c[c >> np.uint64(56) == ORDER + 1] for c, *_ in self.tables]
        keys = np.unique(np.concatenate(full)) if full else np.zeros(0, np.uint64)
        self.bits = self.resolve(keys)
        self.find = _Find(keys) if len(keys) else None

    @staticmethod
    def _context(codes: np.ndarray) -> np.ndarray:
        """A code without its last byte; the order stays in the top byte."""
        top = codes & np.uint64(0xFF << 56)
        return top | ((codes & np.uint64((1 << 56) - 1)) >> np.uint64(8))

    def resolve(self, codes: np.ndarray) -> np.ndarray:
        """Bits of full-order codes in each language (rows: codes)."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        for j, (seen, bits, contexts, escape) in enumerate(self.tables):
            open_ = np.arange(len(codes))
            for order in range(ORDER, -1, -1):
                mask = np.uint64((1 << 8 * (order + 1)) - 1)
                own = (codes[open_] & mask) | np.uint64((order + 1) << 56)
                at = np.minimum(np.searchsorted(seen, own), len(seen) - 1)
                hit = seen[at] == own
                out[open_[hit], j] += bits[at[hit]]
                open_, own = open_[~hit], own[~hit]
                context = self._context(own)
                at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
                known = contexts[at] == context
                out[open_[known], j] += escape[at[known]]
            out[open_, j] += 8.0
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        at, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t) + ORDER
            if size >= CHUNK or i == len(texts) - 1:
                self._chunk(texts[at:i + 1], out[at:i + 1])
                at, size = i + 1, 0
        return out

    def _chunk(self, texts: list[bytes], out: np.ndarray) -> None:
        data = np.frombuffer(PAD + b"".join(t + PAD for t in texts), np.uint8)
        for a in range(0, len(data) - ORDER, 4 * CHUNK):            # long texts in pieces with their context
            codes = _codes(data[a:a + 4 * CHUNK + ORDER], ORDER)
            place, found = self.find(codes)
            bits = self.bits[place]
            miss = np.flatnonzero(~found)
            if len(miss):
                unseen, back = np.unique(codes[miss], return_inverse=True)
                bits[miss] = self.resolve(unseen)[back]
            start = 0
            for i, t in enumerate(texts):
                s, e = max(start, a), min(start + len(t), a + len(codes))
                if s < e:
                    out[i] += bits[s - a:e - a].sum(axis=0, dtype=np.float64)
                start += len(t) + ORDER


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Trees:
    """Trees from at most `per_language` whole texts of each language that are not held out."""
    from pyspark.sql import Window
    i, t, l = (F.col(f"`{c}`") for c in (id_col, text, lang))
    known = docs.select(i.alias("id"), t.alias("text"), l.alias("lang")).filter(l.isNotNull() & t.isNotNull() & i.isNotNull() & ~held_out(id_col))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id", F.lit(SEED)), "id")
    chosen = kept(known.select("id", "lang").distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_language).select("id", "lang"))
    rows = known.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text").mapInArrow(_count, "lang string, code long, n long")
    table = rows.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    chosen.unpersist()
    names, codes, n = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2).to_numpy()
    return Trees({x: (codes[names == x].view(np.uint64), n[names == x]) for x in sorted(set(names.tolist()))})


def identified(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the code length in bits of the chosen language."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("struct<lang:string,score:double,bits:double>")
    def of(texts: pa.Array) -> pa.Array:
        t = shared.value
        values = [x.as_py() for x in texts]
        plain = [i for i, x in enumerate(values) if x and t.languages and any(map(str.isalpha, x))]
        out = [{"lang": "und", "score": 0.0, "bits": None}] * len(values)
        if plain:
            lengths = t.lengths([values[i].encode("utf-8", "surrogatepass") for i in plain])
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1)
            score = 1.0 / np.exp2(np.maximum(least[:, None] - lengths, -1000.0)).sum(axis=1)
            for i, b, s, n in zip(plain, best.tolist(), score.tolist(), least.tolist()):
                out[i] = {"lang": t.languages[b], "score": s, "bits": n}
        return pa.array(out, pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bits", pa.float64())]))

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.select("doc_id", held_out("doc_id").alias("held_out"), of("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", F.col("p.bits").alias("code_bits"))
