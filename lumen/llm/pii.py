"""Personal data by weak supervision.

Base spans come from four patterns (email, ip, card, phone) with their exact checks; they are
always returned.  Looser patterns give further candidates: spelled-out addresses, IPv6, cards
that fail their check digit, national phone numbers; one that overlaps a base span is no
candidate.  Four labelers, each with a test of its own, vote yes, no or nothing on every
candidate: how it is written out (check digit, marks for at and dot, country sign or even
separators), its format (grouping, leading characters), a gazetteer (top-level domains, issuer
prefixes, allocated addresses, area codes) and words in the text before it, for and against.
Expectation-maximisation on the counts of vote patterns (81 for each kind at most) estimates how
reliable each labeler is for each kind, and gives every pattern a probability.  A logistic
regression trained on those probabilities is the final span classifier; besides kind and votes
it sees the span's shape, which no labeler votes on: free edges, separators, length and a colon
or equals sign before it.  A loose candidate that it accepts is added.

Everything that sees text or spans is a DataFrame expression; one pass over the documents writes
each document's candidates with their votes, later steps read only those.  Patterns are written
with possessive parts and look-behinds so that a long run of one character costs linear time.

Defined cases: null text is the empty text, with no spans; positions are code points, end
exclusive; without any candidate nothing is added; rows are independent, so ties, repeated rows
and other columns do not matter.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumen.llm.logistic import ridge_logistic
from lumen.llm.shared import text_of, written

KINDS = ("email", "ip", "card", "phone")
# The base patterns, in forms that match the same spans in linear time.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Looser patterns.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]++(?:(?: ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![.-]?[0-9])",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# The labelers' patterns, formats, gazetteers and context words for and against.
WRITTEN = {
    "email": r"@|[\[(]",
    "ip": r"^[0-9.]+$|[A-Fa-f]",
    "phone": r"^\+|^\([0-9]{3}\) [0-9]{3}-|^[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$",
}
FORMAT = {
    "email": r"(?i)^[a-z0-9][a-z0-9._%+-]*(@| ?[\[(]at[\])] ?| at ).*[a-z]{2,24}$",
    "ip": r"^(?!0)[0-9A-Fa-f.:]+$",
    "card": r"^(?:[0-9]{13,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$",
    "phone": r"^\+(?:[^0-9]*[0-9]){10,13}[^0-9]*$|^\(?[0-9]{3}\)?[ .-][2-9]",
}
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]? ?)(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|au|nl|ch|at|be|ru|cn|jp|in|br|mx)$",
    "ip": r"(?i)^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.|^(?:2[0-9a-f]{3}|f[cde][0-9a-f]{2}):",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|35)",
    "phone": r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?![0-9]{0,3}$)|^\(?[2-9][0-9]{2}",
}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|courriel|correo)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|serveur|servidor)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono)\b",
}
AGAINST = {
    "email": r"(?i)\b(?:look|looked|meet|met|stay|arrive|arrived|available)\b",
    "ip": r"(?i)\b(?:version|release|section|chapter|build|hash|key)\b",
    "card": r"(?i)\b(?:order|invoice|isbn|serial|tracking|reference|account|number)\b",
    "phone": r"(?i)\b(?:order|invoice|isbn|serial|part|ref|sku|pages)\b",
}
# The classifier's shape inputs, read in the characters before a span, in it, and after it.
SHAPES = ("free", "separated", "long", "introduced")
EDGE_BEFORE, EDGE_AFTER = r"(?:^|[\s(\[<:=\x22'])$", r"^(?:$|[\s)\]>,;.!?\x22'])"
SEPARATOR, INTRODUCED = r"[ ().-]", r"[:=]\s*$"
LONG = 16
#: Characters before a candidate that the context labeler reads.
BEFORE = 40
LABELERS = ("pattern", "format", "gazetteer", "context")
NO, YES, ABSTAIN = 0, 1, 2
EM_STEPS = 200
RIDGE = 1.0


def found_spans(text: Column, gaps: Column, pattern: str) -> Column:
    """Array of (start, end, value) of a pattern's matches; gaps: the text split by it."""
    found = F.when(F.size(gaps) > 1, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("value"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.coalesce(F.length(pair["value"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(pair["value"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span))).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(F.size(gaps) > 1, F.aggregate(pairs, empty, step, lambda acc: acc["spans"])).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a number's check digit is right."""
    each = F.filter(F.split(F.reverse(digits(value)), ""), lambda d: d != "")
    parts = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_check(kind: str, value: Column) -> Column:
    """The exact check that a base match must pass."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def described(kind: str, is_base: bool, text: Column, span: Column) -> Column:
    """A candidate with the labelers' votes, in the order of ``LABELERS``, and its shape, in that of ``SHAPES``."""
    value, start = span["value"], span["start"]
    lead = F.least(start, F.lit(BEFORE))
    around = F.substring(text, start - lead + 1, lead + F.length(value) + 1)     # one walk through the text
    before, after = F.substring(around, F.lit(1), lead), F.substring(around, lead + F.length(value) + 1, F.lit(1))
    spelled = luhn(value) if kind == "card" else value.rlike(WRITTEN[kind])
    known = (digits(value) if kind == "card" else value).rlike(GAZETTEER[kind])
    yes_no = [F.when(c, YES).otherwise(NO) for c in (spelled, value.rlike(FORMAT[kind]), known)]
    words = F.when(before.rlike(CONTEXT[kind]), YES).when(before.rlike(AGAINST[kind]), NO).otherwise(ABSTAIN)
    shape = [before.rlike(EDGE_BEFORE) & after.rlike(EDGE_AFTER), value.rlike(SEPARATOR), F.length(value) >= LONG, before.rlike(INTRODUCED)]
    base = luhn(value) if kind == "card" else F.lit(is_base)
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), span["end"].alias("end"), base.alias("base"),
                    F.array(*yes_no, words).alias("votes"), F.array(*[c.cast("int") for c in shape]).alias("shape"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): spans is an array of (start, kind, end, base, votes, shape), one row per document:
    base spans and the loose candidates that overlap none."""
    patterns = [(kind, source is BASE, p) for source in (BASE, LOOSE) for kind, p in source.items()]
    rows = docs.select("doc_id", "text", *[F.split("text", p, -1).alias(f"gaps{i}") for i, (_, _, p) in enumerate(patterns)])

    def checked(kind: str):
        return lambda s: base_check(kind, s["value"])

    arrays = []
    for i, (kind, is_base, p) in enumerate(patterns):
        found = found_spans(F.col("text"), F.col(f"gaps{i}"), p)
        if is_base and kind != "card":                   # a failing match is dropped; a card's is a loose candidate
            found = F.filter(found, checked(kind))
        arrays.append(F.transform(found, functools.partial(described, kind, is_base, F.col("text"))))
    listed = rows.select("doc_id", F.concat(*arrays).alias("spans")).select("doc_id", "spans", F.filter("spans", lambda s: s["base"]).alias("base"))
    clear = F.filter("spans", lambda s: s["base"] | ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return listed.select("doc_id", F.array_sort(clear).alias("spans"))


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]]) -> list[float]:
    """The probability of each (kind, votes, count) pattern, by expectation-maximisation for each kind."""
    out = [0.0] * len(patterns)
    for kind in sorted({k for k, _, _ in patterns}):
        at = [i for i, (k, _, _) in enumerate(patterns) if k == kind]
        vote = np.array([patterns[i][1] for i in at])
        n = np.array([patterns[i][2] for i in at], float)
        p = np.clip(((vote == YES).sum(axis=1) + 0.5) / ((vote != ABSTAIN).sum(axis=1) + 1), 0.05, 0.95)
        for _ in range(EM_STEPS):
            score = []
            for share in (p, 1 - p):                     # smoothed counts, so no probability is 0
                held = (n * share).sum()
                likelihood = np.full(len(at), np.log((held + 1) / (n.sum() + 2)))
                for j in range(vote.shape[1]):
                    for v in (NO, YES, ABSTAIN):
                        same = vote[:, j] == v
                        likelihood[same] += np.log(((n * share)[same].sum() + 0.5) / (held + 1.5))
                score.append(likelihood)
            p = 1 / (1 + np.exp(np.clip(score[1] - score[0], -500, 500)))
        for i, value in zip(at, p, strict=True):
            out[i] = float(value)
    return out


def indicators(kind: int, vote: tuple[int, ...], shape: tuple[int, ...]) -> list[float]:
    """The classifier's inputs: the kind, each labeler's yes and no, and the shape by kind."""
    own = [float(bit and kind == k) for k in range(len(KINDS)) for bit in shape]
    return [float(kind == k) for k in range(len(KINDS))] + [float(v == w) for v in vote for w in (YES, NO)] + own


def fitted(counts: list[tuple[int, tuple[int, ...], tuple[int, ...], int]]) -> np.ndarray | None:
    """Coefficients of the span classifier from (kind, votes, shape, count) rows; None without any."""
    if not counts:
        return None
    by_votes: dict[tuple, int] = {}
    for kind, vote, _, n in counts:
        by_votes[kind, vote] = by_votes.get((kind, vote), 0) + n
    known = dict(zip(by_votes, reliabilities([(*at, n) for at, n in by_votes.items()]), strict=True))
    x = np.array([indicators(k, v, s) for k, v, s, _ in counts])
    y = np.array([known[k, v] for k, v, _, _ in counts])
    n = np.array([c for *_, c in counts], float)
    return ridge_logistic(x, y, n / n.sum() * len(n), RIDGE / 10)


def train(found: DataFrame) -> np.ndarray | None:
    """The span classifier; at most 81 votes in 16 shapes for each kind reach the driver, 5,184 rows."""
    counted = (found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes", "s.shape").count()
               .orderBy("kind", "votes", "shape").collect())
    return fitted([(r["kind"], tuple(r["votes"]), tuple(r["shape"]), r["count"]) for r in counted])


def accepted(span: Column, model: np.ndarray) -> Column:
    logit = F.lit(float(model[0]))
    for k in range(len(KINDS)):
        logit = logit + F.when(span["kind"] == k, float(model[1 + k])).otherwise(0.0)
    for j in range(len(LABELERS)):
        yes, no = (float(model[1 + len(KINDS) + 2 * j + d]) for d in (0, 1))
        logit = logit + F.when(F.get(span["votes"], F.lit(j)) == YES, yes).when(F.get(span["votes"], F.lit(j)) == NO, no).otherwise(0.0)
    first = 1 + len(KINDS) + 2 * len(LABELERS)
    for j in range(len(SHAPES)):
        weight = F.element_at(F.array(*[F.lit(float(model[first + k * len(SHAPES) + j])) for k in range(len(KINDS))]), span["kind"] + 1)
        logit = logit + F.when(F.get(span["shape"], F.lit(j)) == 1, weight).otherwise(0.0)
    return logit > 0


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end) by start and kind; spans: base and accepted ones."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = written(candidates(rows), "pii-candidates")
    model = train(found)

    def short(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["end"]))

    base = F.filter("spans", lambda s: s["base"])
    split = found.select("doc_id", "spans", base.alias("base"))
    if model is None:
        return split.select("doc_id", short(F.col("base")).alias("base"), short(F.col("base")).alias("spans"))

    kept = F.filter("spans", lambda s: s["base"] | accepted(s, model))
    return split.select("doc_id", short(F.col("base")).alias("base"), short(kept).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
