"""Personal data: candidate spans, gradient-boosted trees over format and context, calibrated thresholds.

Everything that reads texts is DataFrame functions. The trees are fitted on the driver to a table of counts whose
size the number of feature values bounds, and are applied as nested conditions.

What a candidate is told apart by never is what its label is made of. A number's check digit and the extent that the base rule
gives it are the labels; digits, separators, the characters and words around it and its neighbours are the features. So the trees learn
from numbers that stand alone which of those the base rule missed, within longer runs, are to be believed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.llm.common import written

#: The kinds in the order in which equal starts are listed. The first four are the base.
KINDS = ("email", "ip", "card", "phone", "card_part", "phone_part", "local_phone", "id_number", "iban")
BASE = 4
_LOCAL = "[A-Za-z0-9._%+-]"
#: The generators. Those of the base find what the stated rules find: look-behinds and possessive repeats only keep
#: them from trying a place that can't match. Card runs of other than 12 to 19 digits fail in any case. The others propose what the base
#: loses: a card or phone number that a longer run of digits swallows, numbers without a country's code, and two more formats.
GENERATORS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "card_part": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5})(?![0-9])",
    "phone_part": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
    "local_phone": r"(?<![0-9A-Za-z+(.-])(?<!\+[0-9]\x20)\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "id_number": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
}
#: The share of random strings of a format that pass its check: a Luhn digit, area codes without some first digits, 97.
#: A phone's extent is no such check: None.
CHANCE = {"card_part": 0.1, "phone_part": None, "local_phone": 0.64, "id_number": 0.89, "iban": 1 / 97}
#: Words before a span that tell of personal data.
_CONTEXT = r"(?i)(?:phone|tel|mobile|call|fax|card|visa|account|mail|contact|ssn|social|passport|id|iban|ip|host)\b[^\n]{0,12}$"
#: Characters before and after a span that are looked at.
REACH = 40
FEATURES = ("kind", "digits", "separators", "context", "left", "right", "near")
TREES, DEPTH, RATE = 16, 3, 0.5
#: A span that the base lacks is redacted from the least score at which this share of held-out spans is right by estimate.
PRECISION = 0.9
#: One of so many texts, by hash, is held out of the fit and sets the thresholds.
HELD_OUT = 3


def _scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``op`` over an array: log2(n) rounds, each over the array shifted by a power of two."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(28)]), lambda p: p < F.size(values))
    return F.aggregate(steps, values, lambda seen, p: F.transform(seen, lambda x, i: F.when(i >= p, op(F.get(seen, i - p), x)).otherwise(x)))


def _bound(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of a value that is worked out once."""
    return F.transform(F.array(value), made)[0]


def _matches(text: Column, pattern: str) -> Column:
    """start and value of each match. The lengths of the matches and of the pieces between them give the places."""
    empty = F.array().cast("array<struct<start:int,value:string>>")

    def listed(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        lengths = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda f, b: F.length(f) + F.length(b))
        return _bound(lengths, lambda n: F.zip_with(found, _scan(n, lambda a, b: a + b), lambda f, end: F.struct((end - F.length(f)).alias("start"), f.alias("value"))))

    return F.when(F.regexp_like(text, F.lit(pattern)), _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), listed)).otherwise(empty)


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(value: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and its letters read as 10 to 35, is 1 modulo 97."""
    bare = F.regexp_replace(value, "[^0-9A-Z]", "")
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _valid(kind: str, value: Column, digits: Column) -> Column:
    n = F.length(digits)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.concat(F.lit("0"), F.substring(F.ltrim(p, F.lit("0")), 1, 3)).cast("int") <= 255))
    if kind in ("card", "card_part"):
        return n.between(12, 19) & _luhn(digits)
    if kind in ("phone", "phone_part"):
        return n.between(9, 15)
    if kind == "local_phone":
        return F.regexp_like(digits, F.lit("^[2-9][0-9]{2}[2-9]"))
    if kind == "id_number":
        return ~F.regexp_like(digits, F.lit("^(?:000|666|9)|^.{3}00|0000$"))
    return _mod97(value) if kind == "iban" else F.lit(True)


_SPAN = "struct<start:int,kind:int,end:int,digits:int,separators:int,valid:int,known:int,context:int,left:int,right:int,near:int>"


def _known(kind: str, digits: Column, before: Column, after: Column, valid: Column) -> Column:
    """Whether a candidate is right as far as its check or the base rule tells, else null.

    A card number within a longer run has an extent that a generator cut out, so its check digit tells nothing. A phone
    number that ends where the base's match ends is right; one that the base takes further, to 15 digits at most, is wrong.
    """
    if kind == "card_part":
        return F.when(~F.regexp_like(before, F.lit(r"[0-9][\x20-]?$")) & ~F.regexp_like(after, F.lit(r"^[\x20-]?[0-9]")), valid)
    if kind == "phone_part":
        run = F.regexp_extract(after, r"^[\x20().0-9-]*[0-9]", 0)
        longer = F.length(F.regexp_replace(run, "[^0-9]", "")) + F.length(digits) <= 15
        return F.when(run == "", valid).when((F.length(run) < REACH) & longer, F.lit(False))
    return valid


def _described(text: Column, k: int, kinds_near: Column):
    """What makes a match of kind number ``k`` a span with its features. valid: it passes its check; known: 1 right, 0 wrong, null not known."""
    kind = KINDS[k]

    def around(c: Column) -> Column:
        return F.when(F.regexp_like(c, F.lit(r"[\p{L}\p{N}_]")), 2).when(F.regexp_like(c, F.lit(r"[^\s]")), 1).otherwise(0)

    def span(m: Column) -> Column:
        value, start = m["value"], m["start"]
        digits, end = F.regexp_replace(value, "[^0-9]", ""), start + F.length(value)
        before = F.substring(text, F.greatest(F.lit(1), start - REACH + 1), F.least(F.lit(REACH), start))
        after = F.substring(text, end + 1, F.lit(REACH))
        valid = _valid(kind, value, digits)
        return F.struct(
            start.alias("start"),
            F.lit(k).alias("kind"),
            end.alias("end"),
            F.least(F.length(digits), F.lit(20)).alias("digits"),
            F.least(F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(6)).alias("separators"),
            valid.cast("int").alias("valid"),
            (F.lit(None) if k < BASE else _known(kind, digits, before, after, valid)).cast("int").alias("known"),
            F.regexp_like(before, F.lit(_CONTEXT)).cast("int").alias("context"),
            around(F.substring(before, -1, 1)).alias("left"),
            around(F.substring(after, 1, 1)).alias("right"),
            kinds_near.alias("near"),
        ).cast(_SPAN)

    return span


def candidates(text: Column) -> Column:
    """All spans that some generator proposes, as an array of structs with the features; spans of two kinds may overlap.

    near: how many of email and ip addresses the text has besides, 2 for more; never a candidate's own kind.
    """
    text = F.coalesce(text, F.lit(""))
    at, digit = F.contains(text, F.lit("@")), F.regexp_like(text, F.lit("[0-9]"))
    needs = {"email": at, "phone": F.contains(text, F.lit("+")), "phone_part": F.contains(text, F.lit("+"))}
    none = F.array().cast(f"array<{_SPAN}>")
    found = F.struct(*[F.when(needs.get(kind, digit), _matches(text, GENERATORS[kind])).otherwise(F.array().cast("array<struct<start:int,value:string>>")).alias(kind) for kind in KINDS])

    def all_of(m: Column) -> Column:
        near = F.least(F.lit(2), F.size(m["email"]) + F.size(m["ip"]))
        return F.concat(*[F.transform(m[kind], _described(text, k, near)) for k, kind in enumerate(KINDS)])

    return F.when(digit | at, _bound(found, all_of)).otherwise(none)


@dataclass(frozen=True)
class Trees:
    """Trees as nested tuples (feature, bound, yes, no) and leaf values; thresholds by kind, above 1 for none."""

    trees: tuple
    start: float
    thresholds: tuple

    def score(self, span: Column) -> Column:
        """The probability that a span is personal data."""

        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, bound, yes, no = node
            return F.when(span[feature] <= bound, value(yes)).otherwise(value(no))

        total = reduce(lambda a, b: a + b, [value(t) for t in self.trees], F.lit(self.start))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def redacts(self, span: Column) -> Column:
        limit = reduce(lambda w, k: w.when(span["kind"] == k, self.thresholds[k]), range(1, len(KINDS)), F.when(span["kind"] == 0, self.thresholds[0]))
        return self.score(span) >= limit

    def plain_score(self, span: dict) -> float:
        """``score`` of one span on the driver."""
        return 1 / (1 + math.exp(-(self.start + sum(_leaf(t, span) for t in self.trees))))


def _leaf(node, row: dict) -> float:
    while not isinstance(node, float):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def estimated_precision(kind: str, right: int, wrong: int) -> float:
    """The share of right ones among candidates that pass the check of their kind.

    A check with a known chance c of passing at random lets c / (1 - c) wrong ones in for each one that it stops; without such
    a chance the share is as counted.
    """
    if not right:
        return 0.0
    chance = CHANCE[kind]
    return right / (right + wrong) if chance is None else 1 - wrong * chance / (1 - chance) / right


def fit(counts: list[dict]) -> Trees:
    """Boost trees on rows of features with n (spans), hits (right ones) and held (1: held out), then set the thresholds.

    Each tree is a Newton step on the logistic loss. A kind's threshold is the least score from which the estimated precision of its
    held-out spans is PRECISION; a kind without such a score gets none.
    """
    counts = [r for r in counts if r["kind"] >= BASE]
    learn = [r for r in counts if not r["held"]]
    total, right = sum(r["n"] for r in learn), sum(r["hits"] for r in learn)
    start, trees = math.log((right + 1) / (total - right + 1)), []
    margin = [start] * len(learn)
    for _ in range(TREES if learn else 0):
        prob = [1 / (1 + math.exp(-m)) for m in margin]
        slope = [r["hits"] - r["n"] * p for r, p in zip(learn, prob, strict=True)]
        curve = [r["n"] * p * (1 - p) for r, p in zip(learn, prob, strict=True)]
        tree = _grow([*range(len(learn))], learn, slope, curve, DEPTH)
        trees.append(tree)
        margin = [m + _leaf(tree, r) for m, r in zip(margin, learn, strict=True)]
    made = Trees(tuple(trees), start, ())
    limits = [2.0] * len(KINDS)
    for k in range(BASE, len(KINDS)):
        by: dict[float, list[int]] = {}
        for r in counts:
            if r["kind"] == k and r["held"]:
                own = by.setdefault(made.plain_score(r), [0, 0])
                own[0], own[1] = own[0] + r["n"], own[1] + r["hits"]
        n = hits = 0
        for score in sorted(by, reverse=True):
            n, hits = n + by[score][0], hits + by[score][1]
            if estimated_precision(KINDS[k], hits, n - hits) >= PRECISION:
                limits[k] = score - 1e-9
    return Trees(made.trees, start, tuple(limits))


def _grow(rows: list[int], counts: list[dict], slope: list[float], curve: list[float], depth: int):
    g, h = sum(slope[i] for i in rows), sum(curve[i] for i in rows)
    best = (1e-6, None, None)
    if depth:
        for f in FEATURES:
            for bound in sorted({counts[i][f] for i in rows})[:-1]:
                yes = [i for i in rows if counts[i][f] <= bound]
                a, b = sum(slope[i] for i in yes), sum(curve[i] for i in yes)
                gain = a * a / (b + 1) + (g - a) ** 2 / (h - b + 1) - g * g / (h + 1)
                if gain > best[0]:
                    best = (gain, f, bound)
    if best[1] is None:
        return RATE * g / (h + 1)
    _, f, bound = best
    return (f, bound, *(_grow([i for i in rows if (counts[i][f] <= bound) == side], counts, slope, curve, depth - 1) for side in (True, False)))


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held (whether the text is held out of the fit) and the candidates c of each row."""
    held = F.pmod(F.xxhash64(F.col(text_col)), F.lit(HELD_OUT)) == 0
    return docs.select(F.col(id_col).alias("doc_id"), held.cast("int").alias("held"), candidates(F.col(text_col)).alias("c"))


def trained(rows: DataFrame) -> Trees:
    """Fit on the candidates of ``described`` rows that are known, gathered as counts by feature values.

    At most as many rows reach the driver as there are feature values (21 digit counts x 7 separators x 2 x 3 x 3 x 3 for each of five
    kinds, held out or not), whatever the input.
    """
    spans = rows.select("held", F.explode(F.filter("c", lambda s: s["known"].isNotNull())).alias("s")).select("held", "s.*")
    counts = spans.groupBy("held", *FEATURES).agg(F.count("*").alias("n"), F.sum("known").alias("hits")).collect()
    return fit(sorted((r.asDict() for r in counts), key=lambda r: [r[f] for f in ("held", *FEATURES)]))


def _unmet(base: Column, extra: Column) -> Column:
    """The spans of ``extra`` that overlap none of ``base``: in the order of starts, no base span before one ends after its start, none after
    one begins before its end."""
    far = F.lit(1 << 30)
    slim = lambda spans, own: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("own"), s["kind"].alias("kind")))
    both = F.array_sort(F.concat(slim(base, 0), slim(extra, 1)))

    def kept(spans: Column) -> Column:
        ends = _scan(F.transform(spans, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(-1)), F.greatest)
        starts = F.reverse(_scan(F.reverse(F.transform(spans, lambda s: F.when(s["own"] == 0, s["start"]).otherwise(far))), F.least))
        told = F.zip_with(F.zip_with(spans, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), starts, lambda x, b: F.struct(x["s"].alias("s"), x["e"].alias("e"), b.alias("b")))
        return F.transform(F.filter(told, lambda t: (t["s"]["own"] == 1) & (t["e"] <= t["s"]["start"]) & (t["b"] >= t["s"]["end"])), lambda t: t["s"])

    return _bound(both, kept)


def labelled(rows: DataFrame, trees: Trees) -> DataFrame:
    """The spans of ``described`` rows: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    listed = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    slim = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = F.filter("c", lambda s: (s["kind"] < BASE) & (s["valid"] == 1))
    extra = F.filter("c", lambda s: (s["kind"] >= BASE) & (s["valid"] == 1) & trees.redacts(s))
    found = rows.select("doc_id", slim(base).alias("base"), slim(extra).alias("extra"))
    added = F.when(F.size("extra") > 0, slim(_unmet(F.col("base"), F.col("extra")))).otherwise(F.col("extra"))
    both = found.select("doc_id", "base", F.concat("base", added).alias("all"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counted = [of_kind(k).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return both.select("doc_id", *counted, F.sha2(F.encode(listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def train(docs: DataFrame, text_col: str = "text") -> Trees:
    """``trained`` on the candidates of all rows of ``docs``."""
    return trained(described(docs, text_col, text_col))


def detected(docs: DataFrame, trees: Trees | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans of the base that pass their check always stay. Others are added where they pass the check of their kind, the trees' score reaches the
    threshold of their kind and no span of the base overlaps them. Null texts count as empty: no spans, the empty string and its digest.
    Ids may be null and may repeat; other columns of ``docs`` are not read. Without ``trees`` they are trained on ``docs``: texts are read
    once then, as the candidates are a table in the shared folder in between.
    """
    rows = described(docs, id_col, text_col)
    if trees is None:
        rows = written(rows, "candidates")
        trees = trained(rows)
    return labelled(rows, trees)
