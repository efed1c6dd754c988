"""Personal data: base rules, and candidates judged by boosted trees.

Base rules find e-mail addresses, IPv4 addresses, card and phone numbers; they always count. For
what is written otherwise (addresses spelled with "at" and "dot", national phone numbers, IPv6,
card groups with a wrong digit) generators propose spans generously, and gradient-boosted trees
over format and context decide; a span is added where the probability reaches its kind's
threshold and no base span or earlier addition overlaps it.

The trees learn from labelled examples written by rule below (a fixed number of rows); the
thresholds are the lowest that reach the wanted precision on a part kept out. The features are
the same DataFrame expressions for examples and documents, and trees become expressions as well,
so documents are read in one pass without Python and without a shuffle.

Positions: a pattern's matches are marked by two control characters, the text is split at them,
and lengths add up to code-point offsets. Patterns use possessive repeats and look-behinds that
leave their matches as they are but keep long runs of one class linear.

Defined cases: null text is empty; an empty result has the hash of the empty text; repeated rows
are treated alike; any length of text is read whole.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posterion.llm.common import fresh
from posterion.llm.rules import let

KINDS = ["email", "ip", "card", "phone"]
# fixed values: the four base patterns, and the generators of candidates by kind
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z.-])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+.,/:-])(?:00|\()?[0-9][0-9() .-]{6,17}[0-9](?![0-9A-Za-z/:%-])",
}
CUES = {
    "email": r"(?:mail|contact|write|reach|address|send)\W{0,3}(?:\w{1,6}\W{1,2})?$",
    "ip": r"(?:ip|host|server|address|ping|from)\W{0,3}(?:\w{1,6}\W{1,2})?$",
    "card": r"(?:card|visa|credit|debit|payment|pay)\W{0,3}(?:\w{1,6}\W{1,2})?$",
    "phone": r"(?:tel|phone|call|fax|mobile|cell|contact|reach|ring|number)\W{0,3}(?:\w{1,6}\W{1,2})?$",
}
AGAINST = r"(?:version|page|pages|order|invoice|isbn|issn|price|cost|total|id|ref|chapter|section|year|model|part|item|serial|build|token)\W{0,4}(?:\w{1,6}\W{1,2})?$"
SPAN = "array<struct<start:int,ord:int,end:int,hit:string>>"
FEATURES = ["kind", "length", "digits", "groups", "first", "last", "paren", "dot", "dash", "space", "cue", "against", "date", "domain", "glued", "valid"]
PRECISION = 0.98


def spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern, leftmost and not overlapping: start, ord (kind), end, hit."""
    none = F.array().cast(SPAN)

    def walk(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("odd"), none.alias("out"))
        return F.aggregate(parts, start, lambda a, p: F.struct(
            (a["at"] + F.length(p)).alias("at"), (~a["odd"]).alias("odd"),
            F.when(a["odd"], F.concat(a["out"], F.array(F.struct(a["at"].alias("start"), F.lit(kind).alias("ord"), (a["at"] + F.length(p)).alias("end"),
                                                                 p.alias("hit"))))).otherwise(a["out"]).alias("out")), lambda a: a["out"])

    marked = F.split(F.regexp_replace(text, pattern, "\x01$0\x02"), "[\x01\x02]")
    return F.when(text.rlike(pattern), walk(marked)).otherwise(none)


def valid(kind: Column, hit: Column) -> Column:
    """The base rules' checks by kind number."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    byte = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (F.when(kind == 0, True).when(kind == 1, hit.rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}\z"))
            .when(kind == 2, F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)).otherwise(F.length(digits).between(9, 15)))


def features(c: Column, text: Column) -> Column:
    """Format and context of a candidate as one struct of numbers."""
    hit, kind = c["hit"], c["ord"]
    before = F.lower(F.substring(text, F.greatest(c["start"] - 23, F.lit(1)), F.least(c["start"], F.lit(24))))
    groups = F.array_remove(F.split(hit, "[^0-9]+"), "")
    count = lambda chars: (F.length(hit) - F.length(F.translate(hit, chars, ""))).cast("double")      # noqa: E731
    cue = F.when(kind == 0, before.rlike(CUES["email"])).when(kind == 1, before.rlike(CUES["ip"])).when(
        kind == 2, before.rlike(CUES["card"])).otherwise(before.rlike(CUES["phone"]))
    values = [kind, F.length(hit), F.length(F.regexp_replace(hit, "[^0-9]", "")), F.size(groups),
              F.length(F.get(groups, F.lit(0))), F.length(F.get(groups, F.size(groups) - 1)), count("("), count("."), count("-"), count(" "),
              cue, before.rlike(AGAINST),
              hit.rlike(r"^(?:19|20)[0-9]{2}[-. ][0-9]{1,2}[-. ][0-9]{1,2}|^[0-9]{1,2}[-. ][0-9]{1,2}[-. ](?:19|20)[0-9]{2}"),
              F.lower(hit).rlike(r"(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$"), before.rlike(r"[#$\p{L}]$"),
              hit.rlike(r"^\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$|^00[0-9]{1,3} ")]
    return F.struct(*(F.coalesce(v.cast("double"), F.lit(0.0)).alias(n) for n, v in zip(FEATURES, values)))


# -- labelled examples ---------------------------------------------------------

def examples(n: int = 2400, seed: int = 7) -> list[tuple[str, int, int]]:
    """(text, kind number, label): one candidate in a sentence, personal data or a look-alike."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))     # noqa: E731
    name = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 8)))     # noqa: E731
    filler = lambda: " ".join(name() for _ in range(r.randint(2, 6)))
    cue = {0: ["mail me:", "contact", "write to", "e-mail"], 1: ["ip", "from host", "server address"], 2: ["card", "visa", "credit card:", "pay with"],
           3: ["call", "phone:", "tel.", "mobile", "fax", "reach me on"]}
    bad = ["version", "page", "order", "invoice no.", "isbn", "price", "total", "id", "ref", "serial", "model", "item", "build"]
    yes = {
        0: lambda: f"{name()}{r.choice(['(at)', ' (at) ', '[at]', ' at '])}{name()}{r.choice(['(dot)', ' dot ', '[dot]'])}{r.choice(['com', 'org', 'net', 'de', 'es', 'fr'])}",
        1: lambda: ":".join("".join(r.choice("0123456789abcdef") for _ in range(r.randint(1, 4))) for _ in range(8)),
        2: lambda: r.choice([" ", "-"]).join(d(4) for _ in range(4)),
        3: lambda: r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}",
                             f"00{r.randint(30, 49)} {d(3)} {d(3)} {d(4)}", f"00{r.randint(30, 49)} {d(2)} {d(7)}"]),
    }
    no = {
        0: lambda: f"{name()} at {name()} dot {name()}",
        1: lambda: ":".join(d(2) for _ in range(8)),
        2: lambda: " ".join(d(4) for _ in range(4)),
        3: lambda: r.choice([f"{r.randint(1900, 2099)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{r.randint(1900, 2099)}", d(r.randint(8, 16)), f"{d(1)}.{d(8)}", f"{d(4)}-{d(4)}",
                             f"{d(3)} {d(3)} {d(3)}", f"{r.randint(1900, 2099)} - {r.randint(1900, 2099)}", f"{d(2)} {d(2)} {d(2)} {d(2)}",
                             f"{d(3)}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(5)}.{d(5)}", f"{d(8)} {d(4)}", f"{d(4)} {d(4)} {d(4)} {d(3)}"]),
    }
    out = []
    for i in range(n):
        kind = r.choice([0, 1, 2, 3, 3, 3])
        if i % 2:
            lead = r.choice(cue[kind]) if kind == 2 or r.random() < 0.6 else name()
            out.append((f"{filler()} {lead} {yes[kind]()} {filler()}", kind, 1))
        else:
            hard = kind == 3 and r.random() < 0.3           # the right form after a telling word
            lead = r.choice(bad) if hard or kind in (1, 2) or r.random() < 0.5 else name()
            out.append((f"{filler()} {lead} {(yes if hard else no)[kind]()} {filler()}", kind, 0))
    return out


# -- boosted trees ---------------------------------------------------------------

@dataclass(frozen=True)
class Trees:
    """base + sum of trees is the log odds; a tree is a leaf value or (feature, cut, left, right)."""
    base: float
    trees: tuple
    thresholds: tuple

    def score(self, f: Column) -> Column:
        def branch(t):
            return F.lit(float(t)) if not isinstance(t, tuple) else F.when(f[FEATURES[t[0]]] <= t[1], branch(t[2])).otherwise(branch(t[3]))
        total = F.lit(self.base)
        for t in self.trees:
            total = total + branch(t)
        return 1.0 / (1.0 + F.exp(-total))


def _grow(x, grad, hess, rows, depth):
    leaf = float(0.3 * grad[rows].sum() / (hess[rows].sum() + 1.0))
    best = (1e-6, None)
    if depth and len(rows) >= 20:
        total = grad[rows].sum() ** 2 / (hess[rows].sum() + 1.0)
        for j in range(x.shape[1]):
            for cut in np.unique(x[rows, j])[:-1]:
                low = rows[x[rows, j] <= cut]
                if 8 <= len(low) <= len(rows) - 8:
                    g, h = grad[low].sum(), hess[low].sum()
                    gain = g * g / (h + 1) + (grad[rows].sum() - g) ** 2 / (hess[rows].sum() - h + 1) - total
                    if gain > best[0]:
                        best = (gain, (j, float(cut)))
    if best[1] is None:
        return leaf
    j, cut = best[1]
    return (j, cut, _grow(x, grad, hess, rows[x[rows, j] <= cut], depth - 1), _grow(x, grad, hess, rows[x[rows, j] > cut], depth - 1))


def _value(t, row):
    while isinstance(t, tuple):
        t = t[2] if row[t[0]] <= t[1] else t[3]
    return t


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 24, depth: int = 3) -> tuple[float, list]:
    """Trees on the gradient of the log loss, each shrunk."""
    share = y.mean()
    base = float(np.log(share / (1 - share)))
    total, trees = np.full(len(y), base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        t = _grow(x, y - p, p * (1 - p), np.arange(len(y)), depth)
        trees.append(t)
        total += np.array([_value(t, row) for row in x])
    return base, trees


def candidates(text: Column) -> Column:
    return F.concat(*(spans(text, LOOSE[k], i) for i, k in enumerate(KINDS)))


def train(spark: SparkSession, precision: float = PRECISION) -> Trees:
    """Trees from two thirds of the examples, thresholds by kind from the rest."""
    rows = spark.createDataFrame(examples(), "text string, kind int, label int")
    found = rows.select("kind", "label", F.get(F.filter(candidates(F.col("text")), lambda c: c["ord"] == F.col("kind")), F.lit(0)).alias("c"), "text").filter("c is not null")
    got = found.select("kind", "label", features(F.col("c"), F.col("text")).alias("f")).collect()
    x, y, kind = np.array([list(r.f) for r in got]), np.array([r.label for r in got], float), np.array([r.kind for r in got])
    check = np.arange(len(y)) % 3 == 2
    base, trees = boost(x[~check], y[~check])
    p = 1 / (1 + np.exp(-(base + np.array([sum(_value(t, row) for t in trees) for row in x]))))
    thresholds = []
    for k in range(len(KINDS)):
        own = check & (kind == k)
        good = [t for t in np.unique(p[own]) if y[own & (p >= t)].mean() >= precision]
        thresholds.append(float(max(0.5, min(good))) if good else 2.0)
    return Trees(base, tuple(trees), tuple(thresholds))


# -- documents --------------------------------------------------------------------

def _by_start(found: Column) -> Column:
    return F.array_sort(found)


def _found(text: Column, trees: Trees) -> Column:
    """struct(base, every): base spans, and these with the additions, both in order."""
    clean = F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "\u00b7\u00b7")
    none = F.array().cast(SPAN)
    limit = F.array(*(F.lit(t) for t in trees.thresholds))

    def both(t: Column) -> Column:
        base = F.filter(F.concat(*(spans(t, BASE[k], i) for i, k in enumerate(KINDS))), lambda c: valid(c["ord"], c["hit"]))
        loose = F.filter(candidates(t), lambda c: let(features(c, t), trees.score) >= F.get(limit, c["ord"]))
        apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])        # noqa: E731

        def settle(pair: Column) -> Column:
            free = F.filter(pair["loose"], lambda c: F.forall(pair["base"], lambda b: apart(b, c)))
            added = F.aggregate(F.array_sort(free), none, lambda out, c: F.when(
                F.exists(out, lambda o: ~apart(o, c)), out).otherwise(F.concat(out, F.array(c))))
            return F.struct(pair["base"].alias("base"), F.when(F.size(pair["loose"]) > 0, F.array_sort(F.concat(pair["base"], added))).otherwise(pair["base"]).alias("every"))

        return let(F.struct(_by_start(base).alias("base"), loose.alias("loose")), settle)

    telling = clean.rlike(r"[0-9@]|(?i:\(at\)|\[at\]| at |:)")
    return F.when(telling, let(clean, both)).otherwise(F.struct(none.alias("base"), none.alias("every")))


def located(docs: DataFrame, trees: Trees, name: str, text: str = "text") -> DataFrame:
    """The table with struct(base, every) of spans (start, ord, end, hit) in a new column."""
    return docs.withColumn(name, _found(F.col(f"`{text}`"), trees))


def listed(found: Column) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The table with every span replaced by its kind in brackets; overlapping spans become one."""
    name, value = fresh(docs, "__found"), F.col(f"`{text}`")
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def rewrite(every: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        step = lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(     # noqa: E731
            a["out"], F.array(F.substring(value, a["at"] + 1, s["start"] - a["at"]), F.get(marks, s["ord"])))).otherwise(a["out"]).alias("out"))
        return F.aggregate(every, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(value, a["at"] + 1, F.length(value))))

    out = located(docs, trees, name, text)
    return out.withColumn(text, F.when(F.size(F.col(name)["every"]) > 0, rewrite(F.col(name)["every"])).otherwise(value)).drop(name)
