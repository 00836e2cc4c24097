"""Personal data by weak supervision, in DataFrame operations only.

Four base kinds are found by pattern and check (email, ip, card, phone). Besides, every match
of a wider pattern is a candidate: base matches, those that fail their check, and all long strings
of letters, digits and what joins them (kind ``secret``), so long words, file names, paths and
identifiers are candidates as well as keys are. Four labelers vote on each candidate, for, against
or not at all: the format (regex; of a secret, how often letters and digits take turns), lists of
known parts (gazetteer: domains, networks, issuers, calling codes, beginnings of issued keys;
against a secret, that it is made of words or is a usual identifier), its borders (context) and
the words before it (cue). Votes are counted by pattern - a table of bounded size - and expectation
maximisation over the patterns estimates how far each labeler is right and how likely each
pattern is personal data. With these soft labels a naive Bayes classifier over the shape of a
candidate and the hashed words around it is trained from counts, again of bounded size. Spans
of the classifier at or above ``least`` are added to the base ones, which always stay; added
spans do not overlap base ones.

The text is scanned twice (counting, marking) and never shuffled; what reaches the driver is
at most kinds x vote patterns x features x buckets counts. A third of all rows may be copies
of one text: nothing is grouped by text.

Patterns are written with possessive loops, which match the same and cannot overflow the stack
or back up on very long runs.

Rules for odd input: a null text counts as empty and has no spans; repeated rows are marked
alike; ties do not arise, as spans of a kind do not overlap; with no candidates nothing is
added; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
#: each finds what the plain pattern finds: a run is tried from its start, or from where the
#: match before ended
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+(?![A-Za-z0-9+/_=-])",
}
#: a text without this has no match
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "secret": r"[A-Za-z0-9+/_=-]{20}"}
BUCKETS = 256
ABSTAIN = 2
LABELERS = ["format", "gazetteer", "borders", "cue"]
LEAST = 0.95

# The gazetteers.
TOP_DOMAINS = "com org net edu gov mil int info biz io co eu uk de fr es it nl be at ch pl pt se no dk fi ie us ca au nz jp cn in br mx ru".split()
SPECIAL_NETWORKS = "0 10 127 169 224 225 226 227 228 229 230 231 232 233 234 235 236 237 238 239 240 255".split()
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|35|6011|65|30[0-5]|36|38|62)"
CALLING_CODES = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689]\d|3[578]\d|42\d|5[09]\d|6[7-9]\d|8[058]\d|9[679]\d)"
ISSUED = r"^(AKIA|ASIA|AIza|ghp_|gho_|ghs_|github_pat_|glpat-|sk[-_]|pk[-_]|rk_|xox[abprs]-|ya29|eyJ|npm_|pypi-|dop_v1_|shpat_|hf_)"
#: where letters and digits take turns; a word among joined parts; usual identifiers
TURN = r"[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"
WORD_PART = r"(?:^|(?<=[-_/=+]))[A-Za-z]{2,}+(?=[-_/=+]|$)"
IDENTIFIER = r"(?i)^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$"
#: characters for each turn, at most in keys and at least in names
TURNS_OF_KEYS, TURNS_OF_NAMES = 6, 9
CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write|reach|courriel|correo)\W*\w*\W*$",
    "ip": r"(?i)(\bip\b|address|host|server|login|from|client)\W*\w*\W*$",
    "card": r"(?i)(card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment)\W*\w*\W*$",
    "phone": r"(?i)(phone|tel|call|mobile|fax|telefon|tél|teléfono)\W*\w*\W*$",
    "secret": r"(?i)(token|key|secret|passw(or)?d|pwd|auth|bearer|credential)s?\W*$",
}


def _found(text: Column, kind: str) -> Column:
    """array<struct<start, end, m, before, after>> of the matches, in code points, end exclusive;
    before and after are what stands beside, up to 32 and 24 characters and at most as far as
    the second match from here."""
    pattern = F.lit(PATTERNS[kind])
    matches, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, PATTERNS[kind], -1)
    none = F.array().cast("array<struct<start:int,end:int,m:string,before:string,after:string>>")
    part = lambda array, i: F.coalesce(F.get(array, i), F.lit(""))

    def placed(s: Column) -> Column:
        def span(m: Column, i: Column) -> Column:
            start = _sum_before(s, i) + F.length(part(s["gaps"], i))
            before = F.right(F.concat(part(s["gaps"], i - 1), part(s["m"], i - 1), part(s["gaps"], i)), F.lit(32))
            after = F.left(F.concat(part(s["gaps"], i + 1), part(s["m"], i + 1), part(s["gaps"], i + 2)), F.lit(24))
            return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("m"), before.alias("before"), after.alias("after"))

        return F.transform(s["m"], span)

    def summed(s: Column) -> Column:
        steps = F.zip_with(F.slice(s["gaps"], 1, F.size(s["m"])), s["m"], lambda g, m: F.length(g) + F.length(m))
        return _let(_with_sums(s, steps), placed)

    spans = _let(F.struct(matches.alias("m"), gaps.alias("gaps")), lambda s: F.when(F.size(s["m"]) > 0, summed(s)).otherwise(none))
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(none)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_sums(s: Column, steps: Column) -> Column:
    """The matches with their steps, and the sum of all steps before each run of about the
    square root of their number: so the sum before any match takes few additions."""
    add = lambda array: F.aggregate(array, F.lit(0), lambda x, y: x + y)
    count = lambda array: F.sequence(F.lit(0), F.size(array) - 1)

    def runs(t: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(t["steps"]) - 1, t["width"])
        sums = F.transform(starts, lambda at: add(F.slice(t["steps"], at + 1, t["width"])))
        heads = _let(sums, lambda x: F.transform(count(x), lambda k: add(F.slice(x, 1, k))))
        return F.struct(s["m"].alias("m"), s["gaps"].alias("gaps"), t["steps"].alias("steps"), t["width"].alias("width"), heads.alias("heads"))

    return _let(F.struct(steps.alias("steps"), F.ceil(F.sqrt(F.size(s["m"]))).cast("int").alias("width")), runs)


def _sum_before(s: Column, i: Column) -> Column:
    run = F.floor(i / s["width"]).cast("int")
    rest = F.slice(s["steps"], run * s["width"] + 1, i - run * s["width"])
    return F.get(s["heads"], run) + F.aggregate(rest, F.lit(0), lambda x, y: x + y)


def _digits(m: Column) -> Column:
    return F.translate(m, " ().+-", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right counts double."""
    n = F.length(digits)
    one = lambda i: F.substring(digits, n - i, F.lit(1)).try_cast("int")
    weigh = lambda i: F.when(i % 2 == 0, one(i)).otherwise(F.when(one(i) > 4, one(i) * 2 - 9).otherwise(one(i) * 2))
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + weigh(i))
    return F.coalesce(total % 10 == 0, F.lit(False))


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(999)) <= 255)
        return F.forall(F.split(m, r"\."), small)
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(m))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(False)


def _candidate(kind: str, m: Column) -> Column:
    """Which matches are worth a vote."""
    if kind == "card":
        return F.length(_digits(m)).between(13, 19)
    if kind == "secret":
        return m.rlike("[A-Za-z]")
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(ABSTAIN)


def _votes(kind: str, c: Column) -> list[Column]:
    m, before, after = c["m"], c["before"], c["after"]
    ever, never = F.lit(True), F.lit(False)
    if kind == "secret":
        turns, usual = F.regexp_count(m, F.lit(TURN)), m.rlike(IDENTIFIER)
        form = _vote((turns * TURNS_OF_KEYS >= F.length(m)) & ~usual, (turns * TURNS_OF_NAMES < F.length(m)) | usual)
        known = _vote(m.rlike(ISSUED), (F.regexp_count(m, F.lit(WORD_PART)) >= 2) | usual)
    else:
        form = _vote(c["ok"], ~c["ok"])
        if kind == "email":
            known = _vote(F.lower(F.element_at(F.split(m, r"\."), -1)).isin(TOP_DOMAINS), never)
        elif kind == "ip":
            known = _vote(~F.split_part(m, F.lit("."), F.lit(1)).isin(SPECIAL_NETWORKS), ever)
        elif kind == "card":
            known = _vote(_digits(m).rlike(ISSUERS), ever)
        else:
            known = _vote(_digits(m).rlike(CALLING_CODES), ever)
    glued = before.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]")
    borders = _vote(~glued, glued)
    cued, assigned = before.rlike(CUES[kind]), before.rlike("[:=]\\s*[\"']?$")
    # something that is no key may be assigned as well, so that alone says nothing of a secret
    cue = _vote(cued, ~cued & ~assigned & before.rlike(r"\p{L}[,;]?\s+$")) if kind == "secret" else _vote(cued | assigned, never)
    return [form, known, borders, cue]


def _features(c: Column) -> list[Column]:
    """Buckets of: shape, the word before, the word after, what stands between it and that."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c["m"], "[0-9]", "9"), "[a-f]", "f"), "[g-zA-Z]", "x")
    size = F.length(c["m"]).cast("string")
    shape = F.concat(size, F.array_join(F.array_sort(F.array_distinct(F.split(shape, ""))), ""), c["ok"].cast("string"))
    word_before = F.lower(F.regexp_extract(c["before"], r"(\p{L}+)[^\p{L}]*$", 1))
    word_after = F.lower(F.regexp_extract(c["after"], r"^[^\p{L}]*(\p{L}+)", 1))
    between = F.regexp_extract(c["before"], r"([^\p{L}]*)$", 1)
    return [F.pmod(F.xxhash64(F.lit(i), v), F.lit(BUCKETS)).cast("int") for i, v in enumerate((shape, word_before, word_after, between))]


def candidates(text: Column, kind: str) -> Column:
    """array<struct<start, end, m, ok, before, after>> of a kind's candidates."""
    wide = lambda s: F.struct(
        s["start"],
        s["end"],
        s["m"],
        _valid(kind, s["m"]).alias("ok"),
        s["before"],
        s["after"],
    )
    return F.transform(F.filter(_found(text, kind), lambda s: _candidate(kind, s["m"])), wide)


@dataclass
class Classifier:
    """Log odds per kind: of the kind, and of each bucket of each feature."""

    start: dict[str, float]
    weights: dict[str, list[list[float]]]


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list[tuple[float, float]], dict]:
    """Expectation maximisation over counts by vote pattern: the share of positives, each
    labeler's (right on positives, right on negatives), and each pattern's probability."""
    n = len(LABELERS)
    prior, right = 0.5, [(0.8, 0.8)] * n
    belief: dict[tuple[int, ...], float] = {}
    held = lambda a, b: min(0.99, max(0.51, (a + 4) / (b + 5)))  # noqa: E731  a labeler is taken to be better than chance
    for _ in range(rounds):
        for votes in patterns:
            yes, no = math.log(prior), math.log(1 - prior)
            for v, (tp, tn) in zip(votes, right, strict=True):
                if v != ABSTAIN:
                    yes += math.log(tp if v else 1 - tp)
                    no += math.log(1 - tn if v else tn)
            belief[votes] = 1 / (1 + math.exp(min(700.0, no - yes)))
        total = sum(patterns.values())
        prior = min(0.99, max(0.01, sum(belief[p] * c for p, c in patterns.items()) / total))
        right = []
        for k in range(n):
            cast = [(p, c) for p, c in patterns.items() if p[k] != ABSTAIN]
            pos, neg = sum(belief[p] * c for p, c in cast), sum((1 - belief[p]) * c for p, c in cast)
            right.append((held(sum(belief[p] * c for p, c in cast if p[k]), pos), held(sum((1 - belief[p]) * c for p, c in cast if not p[k]), neg)))
    return prior, right, belief


def _ballot(kind: str):
    return lambda c: F.struct(F.lit(kind).alias("kind"), F.concat(*[v.cast("string") for v in _votes(kind, c)]).alias("votes"), F.array(*_features(c)).alias("buckets"))


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """Counts votes and features over all texts and fits the classifier to the counts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    voted = [F.transform(candidates(text, kind), _ballot(kind)) for kind in KINDS]
    rows = docs.select(F.explode(F.concat(*voted)).alias("c"))
    counted = rows.select("c.kind", "c.votes", F.posexplode("c.buckets").alias("feature", "bucket")).groupBy("kind", "votes", "feature", "bucket").agg(F.count("*").alias("n"))
    counts = counted.collect()  # bounded: kinds x 3^labelers x features x buckets
    start, weights = {}, {}
    for kind in KINDS:
        own = [r for r in counts if r["kind"] == kind]
        patterns: dict[tuple[int, ...], int] = {}
        for r in own:
            if r["feature"] == 0:
                votes = tuple(map(int, r["votes"]))
                patterns[votes] = patterns.get(votes, 0) + r["n"]
        if not patterns:
            continue
        prior, _, belief = reliabilities(patterns)
        start[kind] = math.log(prior / (1 - prior))
        features = 1 + max(r["feature"] for r in own)
        pos = [[1.0] * BUCKETS for _ in range(features)]
        neg = [[1.0] * BUCKETS for _ in range(features)]
        for r in own:
            p = belief[tuple(map(int, r["votes"]))]
            pos[r["feature"]][r["bucket"]] += p * r["n"]
            neg[r["feature"]][r["bucket"]] += (1 - p) * r["n"]
        weights[kind] = [[math.log(a / sum(ps)) - math.log(b / sum(ns)) for a, b in zip(ps, ns, strict=True)] for ps, ns in zip(pos, neg, strict=True)]
    return Classifier(start, weights)


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def marked(docs: DataFrame, model: Classifier, *, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base spans by kind (arrays ``base_<kind>``) and the added ones
    (``added_<kind>``), each struct<start, end, ...>."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *[candidates(text, k).alias(k) for k in KINDS])
    base = {f"base_{k}": F.filter(k, lambda c: c["ok"]) for k in BASE_KINDS}
    rows = rows.withColumns(base)
    taken = F.concat(*[F.transform(f"base_{k}", lambda c: F.struct(c["start"], c["end"])) for k in BASE_KINDS])
    cut = math.log(least / (1 - least))
    none = F.array().cast("array<struct<start:int,end:int>>")
    for kind in KINDS:
        if kind not in model.weights:
            rows = rows.withColumn(f"added_{kind}", none)
            continue
        sure = _scores(model.start[kind], model.weights[kind], taken, cut)
        kept = F.transform(F.filter(kind, sure), lambda c: F.struct(c["start"], c["end"]))
        rows = rows.withColumn(f"added_{kind}", kept)
    return rows.drop(*KINDS)


def _scores(start: float, weights: list[list[float]], taken: Column, cut: float):
    """The test of a candidate: not a base span, sure enough, and apart from all base spans."""
    tables = [F.array(*[F.lit(w) for w in ws]) for ws in weights]

    def sure(c: Column) -> Column:
        score = F.lit(start)
        for table, bucket in zip(tables, _features(c), strict=True):
            score = score + F.get(table, bucket)
        free = ~F.exists(taken, lambda t: (t["start"] < c["end"]) & (t["end"] > c["start"]))
        return ~c["ok"] & (score >= cut) & free

    return sure


def digest_columns(rows: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and the list of all spans."""
    own = F.array_join(F.concat(*[_listed(k, F.col(f"base_{k}")) for k in BASE_KINDS]), ",")
    every = []
    for k in KINDS:
        both = F.transform(f"base_{k}", lambda c: F.struct(c["start"], c["end"])) if k in BASE_KINDS else F.array().cast("array<struct<start:int,end:int>>")
        every.append(_listed(k, F.array_sort(F.concat(both, F.col(f"added_{k}")))))
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return rows.select("doc_id", *counts, F.sha2(own, 256).alias("base_sha256"), F.array_join(F.concat(*every), ",").alias("spans"))
