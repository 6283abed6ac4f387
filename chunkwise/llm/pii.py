"""Personal data by patterns and by bootstrapped contextual extraction (operator 2).

*Base.* Email addresses, IPv4 addresses, card numbers (Luhn) and phone numbers are
found by regular expressions, leftmost and non-overlapping for each kind. The
pieces between matches come from ``split`` and the matches from
``regexp_extract_all``; running sums of their lengths are the positions.

*Bootstrapping.* The base matches are seeds. A lexical pattern is the word, or the
two words, in front of a token, whatever they are; an instance is a token that could belong to a
kind (``PLAUSIBLE``). Instances and patterns form a bipartite graph, scored in
rounds: a pattern's score for a kind is the confidence-weighted share of all its
occurrences in the corpus, whatever follows there, that precede instances of the
kind; an instance's confidence is 1 for seeds, else that no pattern in front of it
is wrong (noisy or). Patterns that reach ``min_score`` with at least
``min_instances`` different confident instances extract the unseen tokens behind
them. Rounds go on until none accepts a pattern that the one before did not; accepted
patterns never fall out again, so there are at most as many rounds as patterns.
Ordinary words precede ordinary words nearly always, so only contexts such as
``passport no.`` qualify.

Everything is column expressions, joins and aggregations; the regular expressions
are written so that every text takes time linear in its length.

Spans are in code points, end exclusive. Defined results: a null text counts as
empty; repeated rows and null ids are kept, one result for each row; an empty table
gives an empty result; extra columns of the input are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.config import materialize

from .common import in_buckets, out_of_buckets

KINDS = ("email", "ip", "card", "phone")

# Fixed formats. Possessive quantifiers and the look-behinds change no match: they
# keep failing attempts from being repeated at every character of a run.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a format to be tried.
_HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: A token with a digit or an at sign, and what such a token can be.
_TOKEN = r"(?<!\S)\S*[0-9@]\S*"
_EDGES = r"^[^\p{L}\p{N}+@]+|[^\p{L}\p{N}]+$"
PLAUSIBLE = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^(?=.*[.:])[0-9A-Fa-f.:]{7,45}$",
    "card": r"^[0-9](?:-?[0-9]){11,18}$",
    "phone": r"^\+?[0-9(][0-9().-]{5,18}[0-9]$",
}
_RUN = 256

SPANS = "array<struct<start:bigint,end:bigint>>"


def _int(x: int) -> Column:
    return F.lit(x).cast("bigint")


def running_starts(lengths: Column) -> Column:
    """Of an array of lengths: the sum of those before each. Runs of a fixed size are
    summed first, so that the cost stays near linear for long arrays."""
    runs = F.transform(F.sequence(_int(0), F.floor(F.size(lengths) / _RUN)), lambda r: F.slice(lengths, (r * _RUN + 1).cast("int"), F.lit(_RUN)))

    def starts(values: Column, first: Column) -> Column:
        empty = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(values, empty, step, lambda acc: acc["out"])

    totals = F.transform(runs, lambda run: F.aggregate(run, _int(0), lambda a, x: a + x))
    return F.flatten(F.zip_with(runs, starts(totals, _int(0)), starts))


def located(text: Column, pattern: str) -> tuple[Column, Column]:
    """(matches, gaps) of a pattern; there is one gap more than matches."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _luhn(number: Column) -> Column:
    """Whether the digits with separators are 16 to 19 and pass the Luhn check."""
    digits = F.regexp_replace(number, r"[^0-9]", "")
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)


def _octets(address: Column) -> Column:
    parts = F.transform(F.split(address, r"\."), lambda p: F.regexp_replace(p, r"^0+(?=.)", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


def valid(kind: str, match: Column) -> Column:
    if kind == "card":
        return _luhn(match)
    if kind == "ip":
        return _octets(match)
    if kind == "phone":
        return F.length(F.regexp_replace(match, r"[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _placed(found: Column, gaps: Column, keep) -> Column:
    """array<struct<start, end, value, left>> of the matches that ``keep`` holds for; ``left``
    ends with the two words in front."""
    # they lie in the gap before the match, the match before that, or the gap and match before
    # those; of a gap its end is enough
    shifted = lambda values, k: F.concat(F.array_repeat(F.lit(""), k), values)
    ends = F.transform(gaps, lambda g: F.substring_index(F.regexp_replace(g, r"\s+", " "), " ", -4))
    # lengths in turn: gap, match, gap, ...; the match after gap i starts at entry 2 i + 1
    lengths = F.flatten(F.zip_with(gaps, found, lambda g, m: F.array(F.length(g).cast("bigint"), F.coalesce(F.length(m), F.lit(0)).cast("bigint"))))
    starts = F.filter(running_starts(lengths), lambda s, i: i % 2 == 1)
    zipped = F.arrays_zip(found.alias("m"), starts.alias("s"), shifted(found, 2).alias("m2"), shifted(ends, 1).alias("g1"), shifted(found, 1).alias("m1"), ends.alias("g0"))
    spots = F.transform(
        F.filter(zipped, lambda x: x["m"].isNotNull()),
        lambda x: F.struct(x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"), x["m"].alias("value"), F.concat(x["m2"], x["g1"], x["m1"], x["g0"]).alias("left")),
    )
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,value:string,left:string>>")
    return F.when(F.size(found) > 0, F.filter(spots, keep)).otherwise(nothing)


def base_matches(docs: DataFrame, text: Column, tokens: bool = True) -> DataFrame:
    """The documents with one array of matches for each kind and, if asked for, ``tokens``:
    the tokens with a digit or an at sign."""
    keep = lambda kind: lambda x: valid(kind, x["value"])
    formats = {k: (_HINTS[k], FORMATS[k], keep(k)) for k in KINDS}
    if tokens:
        formats["tokens"] = ("[0-9@]", _TOKEN, lambda x: F.lit(True))
    cut = {}
    for name, (hint, pattern, _) in formats.items():
        found, gaps = located(text, pattern)
        none = F.array().cast("array<string>")
        cut[f"__{name}_found"] = F.when(text.rlike(hint), found).otherwise(none)
        cut[f"__{name}_gaps"] = F.when(text.rlike(hint), gaps).otherwise(none)
    docs = docs.withColumns(cut)
    return docs.withColumns({k: _placed(F.col(f"__{k}_found"), F.col(f"__{k}_gaps"), keep) for k, (_, _, keep) in formats.items()}).drop(*cut)


def words_before(left: Column) -> Column:
    """The patterns of a context: its last word and its last two, in lower case."""
    words = F.filter(F.split(F.lower(left), r"\s+"), lambda w: w != "")
    n = F.size(words)
    one = F.when(n >= 1, F.element_at(words, -1))
    two = F.when(n >= 2, F.concat_ws(" ", F.element_at(words, -2), F.element_at(words, -1)))
    return F.filter(F.array(one, two), lambda p: p.isNotNull())


def _instances(found: DataFrame) -> DataFrame:
    """(row_id, kind, pattern, value, start, end, seed): plausible tokens and base
    matches with the patterns in front of them. A token that a base match overlaps is
    no instance of its own."""
    seeds = [
        found.select("row_id", F.lit(k).alias("kind"), F.explode(k).alias("x"), F.lit(True).alias("seed"))
        for k in KINDS
    ]
    taken = F.concat(*[F.transform(F.col(k), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for k in KINDS])
    free = F.filter("tokens", lambda t: ~F.exists(taken, lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    token = found.select("row_id", F.explode(free).alias("x"))
    lead = F.length("x.value") - F.length(F.regexp_replace("x.value", r"^[^\p{L}\p{N}+@]+", ""))
    bare = F.regexp_replace("x.value", _EDGES, "")
    start = F.col("x.start") + lead
    token = token.select("row_id", F.struct(start.alias("start"), (start + F.length(bare)).alias("end"), bare.alias("value"), F.col("x.left").alias("left")).alias("x"))
    loose = [token.where(F.col("x.value").rlike(PLAUSIBLE[k])).select("row_id", F.lit(k).alias("kind"), "x", F.lit(False).alias("seed")) for k in KINDS]
    both = reduce(DataFrame.unionAll, seeds + loose)
    return both.select("row_id", "kind", F.explode(words_before(F.col("x.left"))).alias("pattern"), "x.value", "x.start", "x.end", "seed")


def pattern_counts(text: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern's words occur in the whole corpus."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "")
    rows = text.select(words.alias("w"))
    pairs = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    said = rows.select(F.explode(F.concat("w", pairs)).alias("pattern"))
    return said.join(patterns, "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def learned_patterns(found: DataFrame, text: DataFrame, min_score: float = 0.6, min_instances: int = 5) -> tuple[DataFrame, DataFrame]:
    """(instances, accepted patterns (kind, pattern, score)) after the last round."""
    instances = materialize(_instances(found), "pii_instances")
    edges = instances.groupBy("kind", "pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed"))
    # only patterns with enough different instances of a kind can ever qualify
    wide = edges.groupBy("kind", "pattern").agg(F.count("*").alias("different")).where(F.col("different") >= min_instances).select("kind", "pattern")
    wide = materialize(wide, "pii_patterns")
    edges = materialize(edges.join(wide, ["kind", "pattern"]), "pii_edges")
    totals = materialize(pattern_counts(text, wide.select("pattern").distinct()), "pii_totals")
    trust = edges.select("kind", "value", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("seeded")).groupBy("kind", "value").agg(F.max("seeded").alias("trust"))
    scores, accepted = None, 0
    while True:
        known = edges.join(trust, ["kind", "value"]).join(totals, "pattern")
        scores = known.groupBy("kind", "pattern").agg(
            (F.sum(F.col("n") * F.col("trust")) / F.max("total")).alias("score"), F.count(F.when(F.col("trust") >= min_score, 1)).alias("confident")
        )
        scores = materialize(scores.where((F.col("score") >= min_score) & (F.col("confident") >= min_instances)).select("kind", "pattern", "score"), "pii_scores")
        # trust only grows, and with it scores and the set of accepted patterns
        before, accepted = accepted, scores.count()
        if accepted == before:
            return instances, scores
        doubt = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.coalesce("score", F.lit(0.0))))))
        trust = edges.join(scores, ["kind", "pattern"], "left").groupBy("kind", "value").agg(F.max("seed").alias("s"), (1 - doubt).alias("t"))
        trust = materialize(trust.select("kind", "value", F.when(F.col("s"), 1.0).otherwise(F.col("t")).alias("trust")), "pii_trust")


def _spans(kind: str) -> Column:
    return F.transform(F.col(kind), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def _learned_spans(found: DataFrame, text: DataFrame) -> DataFrame | None:
    """(row_id, new_email, ...): the spans that learned patterns add; None without patterns."""
    instances, patterns = learned_patterns(found, text)
    if not patterns.head(1):
        return None
    new = instances.where(~F.col("seed")).join(patterns, ["kind", "pattern"], "left_semi").groupBy("row_id")
    return new.agg(*[F.collect_set(F.when(F.col("kind") == k, F.struct("start", "end"))).alias(f"new_{k}") for k in KINDS])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bootstrap: bool = True) -> DataFrame:
    """Per row: doc_id, base (struct with one array of spans for each kind), found (the same with
    the spans that learned patterns add) and row_id, a number of the row in this result."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("row_id", F.monotonically_increasing_id())
    text = source.select("text")
    # written once: the numbers of rows are fixed from here on, and the texts stay behind
    found = materialize(base_matches(source, F.col("text")).drop("text"), "pii_base")
    base = F.struct(*[_spans(k).alias(k) for k in KINDS])
    result = found.select("row_id", "doc_id", base.alias("base"))
    if not bootstrap:
        return result.withColumn("found", F.col("base"))
    picked = _learned_spans(found, text)
    if picked is None:
        return result.withColumn("found", F.col("base"))
    joined = result.join(picked, "row_id", "left")
    more = [F.array_sort(F.concat(F.col(f"base.{k}"), F.coalesce(F.col(f"new_{k}"), F.array().cast(SPANS)))).alias(k) for k in KINDS]
    return joined.select("row_id", "doc_id", "base", F.struct(*more).alias("found"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by kind as listed, then start, joined by commas."""

    def named(kind: str) -> Column:
        return F.transform(spans[kind], lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.concat_ws(",", F.concat(*map(named, KINDS)))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span (overlapping ones together) replaced by ``<KIND>``."""

    def named(kind: str) -> Column:
        return F.transform(found[kind], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind.upper()).alias("kind")))

    every = F.array_sort(F.concat(*map(named, KINDS)))
    empty = F.struct(F.array().cast("array<string>").alias("out"), _int(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        between = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(apart, F.concat(acc["out"], F.array(F.concat(between, F.lit("<"), s["kind"], F.lit(">"))))).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    tail = F.aggregate(every, empty, step, lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(every) > 0, tail).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, all columns, with personal data replaced by its kind. Base spans follow
    from a row's own text; spans that learned patterns add are known by the text's digest, so
    only rows that have some are joined, and no text is stored again."""
    name, inner = "__pii_text", "__pii_in"

    def masked(rows: DataFrame, learned: str | None) -> DataFrame:
        # the other columns travel in a struct: their names can't clash
        rows = rows.select(F.struct(*docs.columns).alias(inner), *([f"{learned}{k}" for k in KINDS] if learned else []))
        rows = base_matches(rows, F.coalesce(F.col(inner)[text_col], F.lit("")), tokens=False)
        more = {k: F.coalesce(F.col(f"{learned}{k}"), F.array().cast(SPANS)) if learned else F.array().cast(SPANS) for k in KINDS}
        found = F.struct(*[F.concat(_spans(k), more[k]).alias(k) for k in KINDS])
        return rows.select(*[(redacted(F.col(inner)[c], found) if c == text_col else F.col(inner)[c]).alias(c) for c in docs.columns])

    digest = F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256)
    source = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), digest.alias("row_id"))
    found = materialize(base_matches(source, F.col("text")).drop("text"), "pii_base")
    picked = _learned_spans(found, source.select("text"))
    if picked is not None:
        picked = materialize(picked.withColumnRenamed("row_id", name), "pii_learned")
    if picked is None or not picked.head(1):
        return masked(docs, None)
    named = docs.withColumn(name, digest)
    rest = masked(out_of_buckets(named, name, picked), None)
    return rest.unionAll(masked(in_buckets(named, name, picked).join(picked, name, "left"), "new_"))
