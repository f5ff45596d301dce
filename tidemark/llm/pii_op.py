"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are what four base patterns find (and check): e-mail, IP, payment card, phone. Where
identifiers run into each other the base patterns miss them, and other spellings they
don't know. So:

1. Every seed induces lexical patterns: its shape (digits as 9, runs of letters as a), its shape with
   the word before it, and the two words before it.
2. Candidates are pieces of number runs (a token, or tokens in a row that hold as many digits as a
   phone or card can) and spelled-out addresses that no seed touches and that are valid for the kind
   of a pattern they match.
3. Patterns and distinct instances form a graph. In each round a pattern's score is the mean score of
   its instances, shrunk, and an instance's that of its patterns, combined; seeds stay
   at 1. Only patterns with ``SUPPORT`` distinct seeds count.
4. Candidates that score ``ACCEPT`` or more become spans beside the base ones.

Spans are found within a document's row, without a shuffle; scoring aggregates distinct
(pattern, instance) pairs with partial aggregates, so a frequent pattern is no hot group. Only
accepted candidates are joined back, by document and hash of the text.

Edge cases: null or empty text has no spans; rows that repeat a document give a row each; rows that
share a doc_id but not the text are told apart; a null doc_id is a value like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3
ACCEPT = 0.95
#: Running sums are made in chunks of so many, so that long arrays cost no square.
PIECE = 256

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
#: The base patterns, possessive (they then need no stack for long matches) and tried only where a match can start.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no match.
NEEDS = {"email": "@", "ip": ".", "card": "[0-9]{2}", "phone": "+"}
_IP = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
#: Candidates: runs of number tokens that touch no letter, and addresses with the at sign spelled out.
RUNS = r"(?<![\p{L}\p{N}_.+(-])[+(]?[0-9][0-9().+\x20-]*(?<=[0-9])(?![\p{L}\p{N}_])"
SPELLED = rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(](?i:at)[\])]\x20?{_LABEL}++(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?){_LABEL}++)++"
#: A run is split before each token that holds a digit; what holds none stays with the token before it.
SPLIT = r"\x20(?=[^\x200-9]*+[0-9])"
#: Digits of a piece of two or more tokens: the least of a phone, the most of a card. As every token holds
#: a digit, a piece has ``DIGITS[1]`` tokens at most.
DIGITS = (10, 19)

_SPAN = "struct<start:int,k:int,end:int,hit:string,left:string>"
_SPANS = f"array<{_SPAN}>"


def running(values: Column, step: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """Of an int array: ``step`` folded over the elements before each one."""
    def fold(arr: Column, first: Column) -> Column:
        return F.aggregate(arr, F.struct(first.cast("int").alias("t"), F.array().cast("array<int>").alias("out")),
                           lambda acc, x: F.struct(step(acc["t"], x).cast("int").alias("t"), F.array_append(acc["out"], acc["t"]).alias("out")))["out"]

    chunk = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / PIECE).cast("int")), lambda i: F.slice(values, i * PIECE + 1, F.lit(PIECE)))
    whole = F.transform(chunk, lambda c: F.aggregate(c, F.lit(zero), lambda a, x: step(a, x).cast("int")))
    long = F.flatten(F.zip_with(chunk, fold(whole, F.lit(zero)), fold))
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).when(F.size(values) <= PIECE, fold(values, F.lit(zero))).otherwise(long)


def matches(df: DataFrame, regex: str, out: str, need: str | None = None) -> DataFrame:
    """Adds ``out``: (start, hit, left) of all matches of ``regex`` in ``text``; code points; ``left`` is the text
    since the match before."""
    there = F.lit(True) if need is None else F.col("text").rlike(need) if "[" in need else F.contains("text", F.lit(need))
    none = F.array().cast("array<string>")
    df = df.withColumn("_hit", F.when(there, F.regexp_extract_all("text", F.lit(regex), F.lit(0))).otherwise(none))
    some = F.size("_hit") > 0
    # what lies between the matches, whose lengths give the places
    df = df.withColumn("_gap", F.when(some, F.slice(F.split("text", regex, -1), F.lit(1), F.size("_hit"))).otherwise(none))
    df = df.withColumn("_len", F.zip_with("_gap", "_hit", lambda g, h: F.length(g) + F.length(h)))
    df = df.withColumn("_at", F.when(some, running(F.col("_len"), lambda a, b: a + b)).otherwise(F.array().cast("array<int>")))
    # arrays are zipped, not indexed in a lambda: there an inlined column would be made anew for each element
    found = F.zip_with(F.arrays_zip(F.col("_hit").alias("h"), F.col("_gap").alias("g")), F.col("_at"), lambda x, at: F.struct(
        (at + F.length(x["g"])).cast("int").alias("start"), x["h"].alias("hit"), x["g"].alias("left")))
    return df.withColumn(out, F.when(some, found).otherwise(F.array().cast("array<struct<start:int,hit:string,left:string>>"))).drop("_hit", "_gap", "_len", "_at")


#: Possessive, and tried at the start of words only: linear in the text, however long a word is.
_WORD, _SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"


def last_words(left: Column) -> Column:
    """The last two words of what stands before, whole, with the space after them: all that contexts use."""
    return F.regexp_extract(left, rf"(?<!{_WORD})(?:{_WORD}++{_SPACE}++)?{_WORD}++{_SPACE}*+$", 0)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does the string of digits pass: every second digit from the right doubled, the sum divisible by 10."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 1, F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") / 5)).otherwise(d.cast("int")).cast("int"))
    return F.pmod(F.aggregate(each, F.lit(0), lambda a, b: a + b), F.lit(10)) == 0


def valid(kind: Column, hit: Column) -> Column:
    """Does a match hold as its kind."""
    n = F.length(digits(hit))
    return (F.when(kind == "ip", hit.rlike(_IP)).when(kind == "card", F.when(n.between(14, 19), luhn(digits(hit))).otherwise(False))
            .when(kind == "phone", n.between(10, 15)).otherwise(True))


def _as_spans(found: Column, k: int) -> Column:
    """Matches of one kind that hold, as spans."""
    return F.transform(F.filter(found, lambda m: valid(F.lit(KINDS[k]), m["hit"])), lambda m: F.struct(
        m["start"].alias("start"), F.lit(k).alias("k"), (m["start"] + F.length(m["hit"])).alias("end"), m["hit"].alias("hit"), last_words(m["left"]).alias("left")))


def base_spans(df: DataFrame) -> DataFrame:
    """Adds ``base``: the spans of the base patterns, sorted by start and kind."""
    for k, kind in enumerate(KINDS):
        df = matches(df, BASE[kind], f"_{kind}", NEEDS[kind])
        df = df.withColumn(f"_{kind}", _as_spans(F.col(f"_{kind}"), k))
    both = F.concat(*[F.col(f"_{kind}").cast(_SPANS) for kind in KINDS])
    return df.withColumn("base", F.array_sort(both)).drop(*[f"_{k}" for k in KINDS])


def shape_of(hit: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(hit, r"\p{L}+", "a"), "[0-9]", "9")


def words_before(left: Column, n: int) -> Column:
    """The last ``n`` words of what stands before, in lower case; empty if there are fewer."""
    return F.lower(F.regexp_extract(left, rf"(?<!{_WORD})({_WORD}++(?:{_SPACE}++{_WORD}++){{{n - 1}}}){_SPACE}*+$", 1))


def ends_before(spans: Column) -> Column:
    """How far the spans before each one reach."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest)


def replaced(text: Column, spans: Column, upto: Column, by: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``by(span, end of those before)`` in place of each span; ``upto`` is ``ends_before``."""
    def piece(s: Column, before: Column) -> Column:
        return F.concat(F.substring(text, before + 1, F.greatest(F.lit(0), s["start"] - before)), by(s, before))

    tail = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    return F.concat(F.array_join(F.zip_with(spans, upto, piece), ""), tail)


def pattern_edges(found: DataFrame) -> DataFrame:
    """(kind, pattern, instance) of occurrences (kind, hit, left): what an occurrence says and is."""
    shape, one, two = shape_of(F.col("hit")), words_before(F.col("left"), 1), words_before(F.col("left"), 2)
    pattern = F.filter(F.array(F.concat(F.lit("s|"), shape), F.when(one != "", F.concat(F.lit("l|"), one, F.lit("|"), shape)), F.when(two != "", F.concat(F.lit("w|"), two))), lambda p: p.isNotNull())
    return found.select("kind", F.explode(pattern).alias("pattern"), F.col("hit").alias("instance"), "seed").distinct()


def candidates(df: DataFrame) -> DataFrame:
    """(doc_id, mark, start, end, hit, left) of what no base span touches: those are covered by letters first."""
    some = F.size("base") > 0
    df = df.withColumn("_upto", F.when(some, ends_before(F.col("base"))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("text", F.when(some, replaced(F.col("text"), F.col("base"), F.col("_upto"), lambda s, upto: F.repeat(
        F.lit("x"), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], upto))))).otherwise(F.col("text"))).drop("_upto")
    df = matches(matches(df, RUNS, "_runs", "[0-9]"), SPELLED, "_spelled", "[\\[(][aA][tT]")
    # tokens of each run, where they start and the digits before them, then the pieces that start at each token
    run = F.transform("_runs", lambda m: F.struct(m["start"].alias("start"), last_words(m["left"]).alias("left"), F.split(m["hit"], SPLIT).alias("tok")))
    run = F.transform(run, lambda m: m.withField("at", running(F.transform(m["tok"], lambda t: F.length(t) + 1), lambda a, b: a + b)))
    run = F.transform(run, lambda m: m.withField("n", F.transform(m["tok"], lambda t: F.length(digits(t)))))
    run = F.transform(run, lambda m: m.withField("upto", F.zip_with(running(m["n"], lambda a, b: a + b), m["n"], lambda a, b: a + b)))
    df = df.withColumn("_runs", run)
    tokens = F.flatten(F.transform("_runs", lambda m: F.transform(m["tok"], lambda t, i: F.struct(
        (m["start"] + F.get(m["at"], i)).alias("start"), F.when(i == 0, m["left"]).otherwise(F.lit(" # ")).alias("left"),
        (F.get(m["upto"], i) - F.get(m["n"], i)).alias("before"),
        F.slice(m["tok"], i + 1, F.lit(DIGITS[1])).alias("next"), F.slice(m["upto"], i + 1, F.lit(DIGITS[1])).alias("upto")))))
    # a number starts with a digit, a plus or a bracket; the last token of a piece ends where its digits' own token does
    tokens = F.filter(tokens, lambda t: F.get(t["next"], F.lit(0)).rlike("^[+(]?[0-9]"))
    ends = lambda t: F.filter(F.transform(t["upto"], lambda n, i: F.struct(i.alias("i"), (n - t["before"]).alias("n"))),
                              lambda e: (e["i"] == 0) | e["n"].between(*DIGITS))
    pieces = F.flatten(F.transform(tokens, lambda t: F.transform(ends(t), lambda e: F.struct(
        t["start"].alias("start"), F.array_join(F.concat(F.slice(t["next"], F.lit(1), e["i"]), F.array(F.substring_index(F.get(t["next"], e["i"]), " ", 1))), " ").alias("hit"), t["left"].alias("left")))))
    whole = F.transform("_spelled", lambda m: F.struct(m["start"].alias("start"), m["hit"].alias("hit"), last_words(m["left"]).alias("left")))
    def possible(c: Column) -> Column:
        h = c["hit"]
        return ~h.rlike(r"^\x20|\x20$") & ((F.length(digits(h)) >= 7) | h.rlike(r"[\[(][aA][tT][\])]"))

    # outer, so that no filter on these arrays is pushed below the steps that make them and repeats them
    df = df.withColumn("_pieces", pieces).withColumn("_all", F.filter(F.concat("_pieces", whole), possible))
    some = df.select("doc_id", "mark", F.explode_outer("_all").alias("c")).filter("c is not null")
    return some.select("doc_id", "mark", F.col("c.start").alias("start"), (F.col("c.start") + F.length("c.hit")).alias("end"), F.col("c.hit").alias("hit"), F.col("c.left").alias("left"))


def candidate_kinds(hit: Column) -> Column:
    """Kinds that a candidate is valid for."""
    plus = hit.rlike(r"^[+(]?[0-9]") & ~hit.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]") & ~hit.rlike(r"(?i)\(at\)|\[at\]")
    return F.filter(F.array(F.when(hit.rlike(r"(?i)[\[(]at[\])]"), F.lit("email")), F.when(hit.rlike(_IP), F.lit("ip")),
                            F.when(plus & ~hit.rlike("[^0-9\x20-]") & valid(F.lit("card"), hit), F.lit("card")),
                            F.when(plus & valid(F.lit("phone"), hit), F.lit("phone"))), lambda k: k.isNotNull())


def scored(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, instance, score) of the candidates after some rounds over the graph."""
    # a seed that is also seen as a candidate stays a seed
    nodes = edges.groupBy("kind", "instance").agg(F.max("seed").cast("double").alias("score"))
    score, pairs = nodes, edges.select("kind", "pattern", "instance").distinct()
    for _ in range(rounds):
        joined = pairs.join(score, ["kind", "instance"])
        # seeds and candidates of a pattern, shrunk towards 0 by one instance
        rated = (joined.groupBy("kind", "pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("trust"), F.sum((F.col("score") == 1).cast("long")).alias("seeds"))
                 .filter(F.col("seeds") >= SUPPORT).select("kind", "pattern", "trust"))
        miss = (pairs.join(rated, ["kind", "pattern"]).groupBy("kind", "instance")
                .agg(F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999999))))).alias("miss")))
        score = (nodes.join(miss, ["kind", "instance"], "left")
                 .select("kind", "instance", F.when(F.col("score") == 1, 1.0).otherwise(1 - F.coalesce("miss", F.lit(1.0))).alias("score")))
        score = stored(score, "scores")
    return score


def find(docs: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, ``keys``, mark (hash of the text), base and more: arrays of spans (start, k, end, ...)
    in order, k an index into ``KINDS``."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, F.col("text").cast("string").alias("text"))
    src = src.withColumn("mark", F.xxhash64("text")).withColumn("text", F.coalesce("text", F.lit("")))
    based = base_spans(src)
    # the base spans and the candidates of each row, once
    cand = stored(candidates(based.select("doc_id", "mark", "text", "base")).distinct(), "candidates")
    base = stored(based.drop("text"), "base")
    seeds = (base.select(F.explode("base").alias("b")).select(F.element_at(F.array(*map(F.lit, KINDS)), F.col("b.k") + 1).alias("kind"), F.col("b.hit").alias("hit"), F.col("b.left").alias("left")))
    kinds = cand.withColumn("kind", F.explode(candidate_kinds(F.col("hit"))))
    both = pattern_edges(seeds.withColumn("seed", F.lit(1))).unionByName(pattern_edges(kinds.select("kind", "hit", "left").withColumn("seed", F.lit(0))))
    accepted = scored(stored(both, "edges")).filter(F.col("score") >= ACCEPT).select("kind", F.col("instance").alias("hit"))
    more = (kinds.join(accepted, ["kind", "hit"]).select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.struct(
        "start", (F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1).cast("int").alias("k"), F.col("end").cast("int").alias("end"), "hit", "left").cast(_SPAN).alias("s"))
        .groupBy("_d", "_m").agg(F.array_sort(F.collect_set("s")).alias("more")))
    out = base.join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left").drop("_d", "_m")
    return out.withColumn("more", F.coalesce("more", F.array().cast(_SPANS)))


def written(spans: Column) -> Column:
    """kind:start:end of spans in order, by commas."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(kind, s["k"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = [F.size(F.filter(F.transform("base", lambda s: s["k"]), F.lit(k).eqNullSafe)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        written(F.array_sort(F.concat("base", "more"))).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; spans that overlap give one label, the first one's."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    found = find(plain.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    spans = (found.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.array_sort(F.concat("base", "more")).alias("spans"))
             .filter(F.size("spans") > 0).dropDuplicates(["_d", "_m"]))
    out = plain.join(spans, F.col(doc_id).cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(text) == F.col("_m")), "left")
    out = out.withColumn("_upto", ends_before(F.col("spans")))
    label = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    new = replaced(F.col(text), F.col("spans"), F.col("_upto"), lambda s, upto: F.when(s["start"] >= upto, F.get(label, s["k"])).otherwise(F.lit("")))
    return out.withColumn(text, F.when(F.col("spans").isNull(), F.col(text)).otherwise(new)).select(*names).toDF(*docs.columns)
