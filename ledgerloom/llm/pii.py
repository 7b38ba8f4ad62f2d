"""Personal data: base patterns, and spans added by weak supervision. Column expressions and aggregates only.

1. **Candidates.** The base spans (email, ip, card, phone) and other runs of characters with digits that might identify someone.
2. **Labelers** vote for (1), against (-1) or abstain (0): patterns, a gazetteer of cue words before the span, and the context
   around it.
3. **Expectation-maximisation** over the counts of vote patterns (a table whose size is bounded by the number of labelers)
   estimates how common personal data is among candidates and how reliable each labeler is: an aggregate per iteration.
4. **Classifier.** A naive Bayes model of a span's own features, trained on the posteriors of all candidates, scores every span.
   Base spans stay whatever it says; other spans are added if it is in favour.

Positions are code points, ends exclusive. The patterns are possessive forms, with a look behind where that spares restarts, which match what
the plain ones do without their backtracking. Defined results: a null text is empty; a text of any length is searched whole; repeated
rows and equal ids are searched row by row; with no candidates nothing is added; an empty table gives an empty table; other
columns are carried by ``redact`` and ignored by ``find``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.quality import held_back
from ledgerloom.session import stage

KINDS = ("email", "ip", "card", "phone", "number", "secret")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OTHER = r"(?<![A-Za-z0-9_])(?=[A-Za-z_-]{0,40}+[0-9])[A-Za-z0-9_](?:[A-Za-z0-9_]|[-./](?=[A-Za-z0-9_]))++"
CUES = (
    r"\b(token|key|secret|password|passwd|pwd|pin|phone|tel|mobile|call|fax|email|mail|e-mail|contact|card|visa|account|iban|ssn|passport"
    r"|licen[cs]e no|id|ip|host|address|login|user|username|auth|bearer|credential)\b"
)
STRICT = r"^(?:[0-9a-fA-F]{32,128}|[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|(?:sk|pk|ghp|AKIA)[_A-Za-z0-9-]{16,})$"
LABELERS = ("pattern", "gazetteer", "assigned", "quoted", "mixed", "glued")
FEATURES = ("kind", "size", "digits", "letters", "joints", "cue", "sign", "quote")
ITERATIONS = 12
BEFORE, AFTER = 24, 2


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    one = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * (1 + i % 2))
    return F.aggregate(one, F.lit(0), lambda acc, n: acc + F.when(n > 9, n - 9).otherwise(n)) % 10 == 0


def _sound(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).try_cast("int") <= 255))
    size = F.length(_digits(match))
    if kind == "card":
        return size.between(13, 19) & _luhn(_digits(match))
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda span: _sound(kind, span["text"])


SPAN = "array<struct<kind:string,start:int,end:int,text:string>>"


def _matches(text: Column, kind: Column | str, pattern: str, needs: str) -> Column:
    """Spans of a pattern: the gaps between matches, and the matches, give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    none = F.array().cast(SPAN)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        name = F.lit(kind) if isinstance(kind, str) else F.when(pair["match"].rlike("[A-Za-z]"), "secret").otherwise("number")
        span = F.struct(name.alias("kind"), start.alias("start"), end.alias("end"), pair["match"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).cast(SPAN).alias("spans"))

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda p: p["match"].isNotNull())
    first = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(needs), F.aggregate(pairs, first, step, lambda acc: acc["spans"])).otherwise(none)


NEEDS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}


def _annotated(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_whole``, ``_base`` and ``_other``: base spans, and candidates that overlap none of them."""
    df = docs.withColumn("_whole", F.coalesce(F.col(text), F.lit("")))
    for kind, pattern in BASE.items():
        # regexp_extract_all and split see the same matches
        df = df.withColumn(f"_{kind}", _matches(F.col("_whole"), kind, pattern, NEEDS[kind]))
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", _checked(kind)))
    df = df.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in BASE]))
    df = df.withColumn("_free", _matches(F.col("_whole"), F.lit(None), OTHER, "[0-9]"))
    apart = lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return df.withColumn("_other", F.filter("_free", apart))


def _described(span: Column, whole: Column) -> Column:
    """What labelers and the classifier look at, of one span."""
    text = span["text"]
    before = F.lower(F.substr(whole, F.greatest(span["start"] - BEFORE + 1, F.lit(1)), F.least(span["start"], F.lit(BEFORE))))
    after = F.substr(whole, span["end"] + 1, F.lit(AFTER))
    digits, letters = F.length(_digits(text)), F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    size = F.length(text)
    strict = span["kind"].isin(*BASE) | text.rlike(STRICT)
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    return F.struct(
        vote(strict, digits + letters < 7).alias("pattern"),
        vote(before.rlike(CUES)).alias("gazetteer"),
        vote(before.rlike(r"[=:]\s*[\"']?$")).alias("assigned"),
        vote(before.rlike("[\"']$") & after.rlike("^[\"']")).alias("quoted"),
        vote((digits >= 4) & (letters >= 4) & (size >= 16), (letters > 3 * digits) | (size < 7)).alias("mixed"),
        vote(F.lit(False), before.rlike(r"[^\s\"'(=:,;|]$") | after.rlike(r"^[^\s\"'),.;:|!?#*$%&]")).alias("glued"),
        span["kind"].alias("kind"),
        F.least(F.floor(F.log2(size.cast("double"))), F.lit(6)).cast("int").cast("string").alias("size"),
        F.least(F.floor(F.log2(digits.cast("double") + 1)), F.lit(5)).cast("int").cast("string").alias("digits"),
        F.least(F.floor(F.log2(letters.cast("double") + 1)), F.lit(5)).cast("int").cast("string").alias("letters"),
        F.least(size - digits - letters, F.lit(3)).cast("string").alias("joints"),
        before.rlike(CUES).cast("string").alias("cue"),
        before.rlike(r"[=:]\s*[\"']?$").cast("string").alias("sign"),
        after.rlike("^[\"']").cast("string").alias("quote"),
    )


def _posterior(prior: float, right: dict[str, float]) -> Column:
    """Chance that a candidate is personal, from its votes and the labelers' reliabilities."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for name in LABELERS:
        odds = odds + F.col(name) * math.log(right[name] / (1 - right[name]))
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, iterations: int = ITERATIONS) -> tuple[float, dict[str, float]]:
    """The prior and the reliability of every labeler, by expectation-maximisation over counted vote patterns."""
    prior, right = 0.5, dict.fromkeys(LABELERS, 0.8)
    for _ in range(iterations):
        p, n = _posterior(prior, right), F.col("n")
        sums = [F.sum(n).alias("n"), F.sum(n * p).alias("yes")]
        for name in LABELERS:
            sums.append(F.sum(F.when(F.col(name) != 0, n)).alias(f"{name}_n"))
            sums.append(F.sum(F.when(F.col(name) > 0, n * p).when(F.col(name) < 0, n * (1 - p))).alias(f"{name}_right"))
        row = patterns.agg(*sums).first()
        if not row["n"]:
            break
        prior = min(0.99, max(0.01, (row["yes"] + 1) / (row["n"] + 2)))
        for name in LABELERS:
            right[name] = min(0.99, max(0.55, ((row[f"{name}_right"] or 0) + 4) / ((row[f"{name}_n"] or 0) + 5)))
    return prior, right


def train(docs: DataFrame, text: str = "text") -> dict:
    """Reliabilities and the classifier, from all candidates of ``docs``. Holds a few hundred numbers."""
    df = _annotated(docs.select(F.col(text).alias("_text")), "_text")
    df = df.withColumn("_any", held_back((F.size("_base") > 0) | (F.size("_other") > 0))).filter("_any")
    spans = df.select("_whole", F.explode(F.concat("_base", "_other")).alias("_span"))
    seen = spans.select(_described(F.col("_span"), F.col("_whole")).alias("d")).select("d.*")
    table = stage(seen.groupBy(*LABELERS, *FEATURES).agg(F.count("*").alias("n")), "pii-patterns")
    prior, right = estimate(table)
    scored = table.select("n", _posterior(prior, right).alias("p"), F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])).alias("x"))
    sums = scored.groupBy("x.feature", "x.value").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
    yes = sum(r["yes"] for r in sums) / len(FEATURES)
    no = sum(r["no"] for r in sums) / len(FEATURES)
    weights = {(r["feature"], r["value"]): math.log((r["yes"] + 1) / (yes + 8) * (no + 8) / (r["no"] + 1)) for r in sums}
    return {"prior": prior, "reliability": right, "bias": math.log((yes + 1) / (no + 1)), "weights": weights}


def _favoured(model: dict, described: Column) -> Column:
    score = F.lit(model["bias"])
    for f in FEATURES:
        chosen = F.lit(0.0)
        for (name, value), weight in sorted(model["weights"].items()):
            if name == f:
                chosen = F.when(described[f] == value, weight).otherwise(chosen)
        score = score + chosen
    return score > 0


def _found(docs: DataFrame, text: str, model: dict) -> DataFrame:
    df = _annotated(docs, text)
    described = F.transform("_other", lambda s: F.struct(s.alias("span"), _described(s, F.col("_whole")).alias("d")))
    df = df.withColumn("_seen", described)
    added = F.transform(F.filter("_seen", lambda x: _favoured(model, x["d"])), lambda x: x["span"])
    df = df.withColumn("_added", added if model["weights"] else F.array().cast(SPAN))
    return df.withColumn("_spans", F.concat("_base", "_added"))


def in_order(spans: Column) -> Column:
    """Sorted by kind as listed, then start."""
    place = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(place(s).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", model: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: ``base`` and ``spans``, arrays of (kind, start, end) in order."""
    model = model or train(docs, text)
    df = _found(docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")), "_text", model)
    slim = lambda c: F.transform(in_order(F.col(c)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return df.select(F.col("_id").alias(id), slim("_base").alias("base"), slim("_spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", model: dict | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; overlapping spans give one replacement."""
    model = model or train(docs, text)
    df = _found(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text", model)
    by_start = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(F.col("_whole"), acc["at"] + 1, s["start"] - acc["at"])
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        more = F.when(s["start"] >= acc["at"], F.array(gap, tag)).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], more).cast("array<string>").alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(by_start, first, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(F.col("_whole"), acc["at"] + 1)))
    df = df.withColumn("_clean", F.when(F.size("_spans") > 0, done).otherwise(F.col("_text")))
    return df.select(*[(F.col("_clean") if x == text else F.col("_row")[x]).alias(x) for x in docs.columns])
