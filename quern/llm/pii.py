"""Personal data: fixed shapes, and unseen identifiers found by bootstrapped contexts.

Fixed shapes (e-mail, address, card, phone, long secret) give the seed entities. The words
before a seed form a lexical pattern. Patterns and the identifier-like tokens that they
introduce make a bipartite graph; confidence goes from instances to patterns and back for a
few rounds, and tokens behind patterns of high confidence are reported too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import free_name, whole
from quern.session import materialize

#: Shapes of the base kinds and of the characters that a text must have to hold one. Fixed values.
#: Repeated groups are possessive, which changes no match here, as nothing that follows could take
#: back a repetition; a group that can be taken back costs a level of Java's stack for each.
BASE = {
    "email": (r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", ""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}

#: Seeds of the kind that has no checked shape: long tokens that mix letters and digits.
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{24,}(?![A-Za-z0-9_@-])"

#: Tokens that may be an identifier: six characters or more with a digit or an at sign within.
CANDIDATE = r"(?<![A-Za-z0-9@._+-])(?=[A-Za-z@._+-]*[0-9@])[A-Za-z0-9@+][A-Za-z0-9@._+-]{4,}[A-Za-z0-9](?![A-Za-z0-9@])"

KINDS = [*BASE, "secret"]

_SPAN = "array<struct<kind:int,start:int,end:int,left:string,entity:string>>"


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, characters of context, and what a pattern needs to be trusted."""

    rounds: int = 3
    context_chars: int = 64
    min_confidence: float = 0.8
    min_seeds: int = 3


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-sum."""
    n = F.length(digits)
    value = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1),
    )
    return F.aggregate(value, F.lit(0), lambda total, v: total + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.coalesce(F.length(F.ltrim(p, F.lit("0"))) <= 3, F.lit(False)) & (F.coalesce(F.right(p, F.lit(9)).cast("int"), F.lit(999)) <= 255))
    digits = F.regexp_replace(match, r"[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _found(text: str, kind: str, pattern: str, context: int, ok) -> Column:
    """Matches of a pattern in order as structs, with the end of the text before each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("before"), found.alias("match"))
    number = F.lit(KINDS.index(kind) if kind in KINDS else -1)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(_SPAN).alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["before"])
        end = start + F.length(x["match"])
        left = F.right(F.concat(state["tail"], x["before"]), F.lit(context))
        span = F.struct(number.alias("kind"), start.alias("start"), end.alias("end"), left.alias("left"), x["match"].alias("entity"))
        take = x["match"].isNotNull() & F.coalesce(ok(x["match"]), F.lit(False))
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.right(F.concat(left, F.coalesce(x["match"], F.lit(""))), F.lit(context)).alias("tail"),
            F.when(take, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(both, begin, step, lambda state: state["out"])


def find_spans(docs: DataFrame, keep: list[str], text: str = "text", setup: Bootstrap = Bootstrap()) -> DataFrame:
    """Seeds and candidates of every text, within its row.

    Returns ``keep``, then ``base`` (the checked shapes, ordered by kind and start),
    ``secrets`` and ``candidates``, each an array of (kind, start, end, left, entity).
    """
    df = docs.select(*keep, whole(text).alias("__t"))
    digit = F.col("__t").rlike("[0-9]")
    none = F.array().cast(_SPAN)
    parts = []
    for kind, (pattern, needs) in BASE.items():
        gate = F.contains(F.col("__t"), F.lit(needs)) if needs else F.lit(True)
        gate = gate if kind == "email" else gate & digit
        gate = gate & F.col("__t").rlike(pattern)
        parts.append(F.when(gate, _found("__t", kind, pattern, setup.context_chars, lambda m, k=kind: _valid(k, m))).otherwise(none))
    every = lambda m: F.lit(True)
    secret = F.when(digit & F.col("__t").rlike(SECRET), _found("__t", "secret", SECRET, setup.context_chars, every)).otherwise(none)
    other = F.when(digit | F.contains(F.col("__t"), F.lit("@")), _found("__t", "candidate", CANDIDATE, setup.context_chars, every)).otherwise(none)
    return df.select(*keep, F.concat(*parts).alias("base"), secret.alias("secrets"), other.alias("candidates"))


def context_pattern(left: Column) -> Column:
    """The last two words before an entity, and what stands directly before it, in a plain form.

    Digits become 0 and white space one space, so that contexts that differ in numbers only
    are one pattern. Empty where there are no two words.
    """
    tail = F.regexp_extract(left, r"(\S+\s+\S+\s+\S{0,3})$", 1)
    return F.regexp_replace(F.regexp_replace(F.lower(tail), r"[0-9]+", "0"), r"\s+", " ")


def score_patterns(edges: DataFrame, setup: Bootstrap = Bootstrap()) -> DataFrame:
    """Confidence of every (pattern, kind) after the rounds of scoring.

    ``edges`` has ``pattern``, ``instance`` and ``seed`` (the kind of a seed instance, NULL for
    candidates), one row per occurrence or per distinct pair. Seeds are certain. A pattern's
    confidence in a kind is the mean confidence of its instances, shrunk by one instance that
    is wrong; an instance that is no seed is as likely as its patterns together make it
    (noisy or). Only patterns that introduce a seed of the kind are scored.

    Sums are aggregated before each shuffle, so a pattern with a third of all occurrences
    is a single row in every join. The tables of each round are written, not kept by lineage.
    """
    links = materialize(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-links")
    sizes = links.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = links.filter("seed IS NOT NULL").groupBy("pattern", F.col("seed").alias("kind")).agg(F.count("*").alias("n_seeds"))
    known = materialize(seeds.join(sizes, "pattern"), "pii-seeds")
    scored = known.withColumn("confidence", F.col("n_seeds") / (F.col("n") + 1))
    for _ in range(setup.rounds):
        # Only instances behind a scored pattern can gain from it.
        open_links = links.filter("seed IS NULL").join(scored.select("pattern", "kind", "confidence"), "pattern")
        belief = open_links.groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("belief")
        )
        gained = (
            links.filter("seed IS NULL").select("pattern", "instance")
            .join(belief, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("belief").alias("gained"))
        )
        scored = materialize(
            known.join(gained, ["pattern", "kind"], "left").withColumn(
                "confidence", (F.col("n_seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("n") + 1)
            ).drop("gained"),
            "pii-round",
        )
    return scored


def detect_pii(docs: DataFrame, keep: list[str], text: str = "text", setup: Bootstrap = Bootstrap()) -> DataFrame:
    """All spans of personal data of every text.

    Returns the columns in ``keep`` (not named ``base`` or ``spans``), ``base`` and ``spans``:
    arrays of (kind, start, end) in code points, ordered by kind as listed in ``KINDS``, then
    start. ``base`` has the checked shapes alone, ``spans`` also the secrets and the unseen
    identifiers, which never overlap a base span. A NULL or empty text has none; an empty
    table gives an empty result; repeated rows are searched each.
    """
    row = free_name(docs.columns, "pii_row")
    named = find_spans(docs.withColumn(row, F.monotonically_increasing_id()), [row, *keep], text, setup)
    found = materialize(named, "pii-spans")

    def occurrences(column: str, seed: Column) -> DataFrame:
        one = found.select(row, "base", F.explode(column).alias("s"))
        pattern = context_pattern(F.col("s.left"))
        return one.select(
            row, "base", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
            F.col("s.entity").alias("instance"), pattern.alias("pattern"), seed.alias("seed"),
        ).filter("pattern != ''")

    def beside(spans: Column) -> Column:
        return ~F.exists(spans, lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))

    seeds = occurrences("base", F.col("s.kind")).unionByName(occurrences("secrets", F.lit(KINDS.index("secret"))))
    fresh = occurrences("candidates", F.lit(None).cast("int")).filter(beside(F.col("base")))
    edges = seeds.select("pattern", "instance", "seed").unionByName(fresh.select("pattern", "instance", "seed"))
    trusted = score_patterns(edges, setup).filter(
        (F.col("confidence") >= setup.min_confidence) & (F.col("n_seeds") >= setup.min_seeds)
    )
    best = trusted.groupBy("pattern").agg(F.min_by("kind", F.struct(-F.col("confidence"), F.col("kind"))).alias("kind"))
    unseen = (
        fresh.join(best, "pattern")
        .groupBy(row)
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("unseen"))
    )
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    secrets = F.filter("secrets", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
    # Only texts with candidates can gain by the join; the others, which are most, are not shuffled for it.
    some = F.size("candidates") > 0
    ready = lambda rows: rows.select(row, *keep, plain("base").alias("base"), plain(secrets).alias("secrets"))
    none = F.lit(None).cast(unseen.schema["unseen"].dataType).alias("unseen")
    joined = ready(found.where(some)).join(unseen, row, "left").unionByName(ready(found.where(~some)).select("*", none))
    # A secret may be found by its shape and by its context: the shape's span stays.
    new = F.filter(
        F.coalesce("unseen", F.array().cast("array<struct<kind:int,start:int,end:int>>")),
        lambda u: ~F.exists("secrets", lambda s: (s["start"] < u["end"]) & (s["end"] > u["start"])),
    )
    return joined.select(*keep, "base", F.array_sort(F.array_union(F.array_union("base", "secrets"), new)).alias("spans"))


def spans_text(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def mask(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets.

    Spans may overlap; of those that do, the one that starts first, and then the longest, names
    the gap that covers them all. NULL texts stay NULL.
    """
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    ordered = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind")))
    )
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        before = F.substring(text, state["at"] + 1, F.greatest(x["start"] - state["at"], F.lit(0)))
        piece = F.when(x["start"] >= state["at"], F.array(before, F.get(kinds, x["kind"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], -x["minus_end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    return F.when(
        F.size(spans) > 0,
        F.aggregate(ordered, begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))),
    ).otherwise(text)


def mask_pii(docs: DataFrame, text: str = "text", setup: Bootstrap = Bootstrap()) -> DataFrame:
    """The documents, with personal data in their texts replaced by the kind of each."""
    plain = docs.select([F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index(text)
    found = detect_pii(plain, plain.columns, f"c{at}", setup)
    masked = found.withColumn(f"c{at}", mask(F.col(f"c{at}"), F.col("spans")))
    return masked.select([F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
