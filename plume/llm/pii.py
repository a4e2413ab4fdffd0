"""Personal data: base patterns, and bootstrapped contextual extraction.

Base entities (email, ip, card, phone) are found by patterns.  They are the
seeds of a bootstrap over lexical contexts: the one or two words before an
entity are its patterns.  Tokens with six digits or more that no base pattern
took are candidates with patterns of their own.  Patterns and instances form a
weighted graph, over which Spark iterates:

* a pattern's confidence in a kind is the share of its instances' weight that
  belongs to the kind, corrected for the kind's share of all instances (so a
  common word that precedes everything has none), with ``prior`` instances of
  doubt;
* a candidate instance belongs to a kind by 1 - product(1 - confidence) over
  its patterns that are confident enough.

Candidates after a pattern that ends with ``confident`` or more are reported
under the pattern's kind.

Only DataFrame functions are used.  Pattern matches are located by splitting
the text at them and adding up lengths, so positions are in code points.  The
patterns are written with possessive quantifiers and may only start where a
run of their first characters starts (or a match ended): the same matches,
without trying every tail of a long run.

Cases: a null text counts as empty; repeated rows are rows of their own, but
an instance counts once per pattern and document; very long texts are searched
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9](?:[._@+/-]?[A-Za-z0-9])*+"
_CONTEXT = 80  # characters before an entity in which its two words of context are looked for
_SPANS = "array<struct<start:bigint,end:bigint,found:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


#: What a match must satisfy.
VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda m: F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}
#: A quick test that no text with a match fails.
MAYBE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
}


def located(text: Column, pattern: str) -> Column:
    """Start, end and text of every match, in order."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.lit(0).cast("long")
    done = F.aggregate(
        F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("found")),
        F.struct(zero.alias("at"), F.array().cast(_SPANS).alias("spans")),
        lambda a, m: F.struct(
            (a["at"] + F.length(m["gap"]) + F.length(m["found"])).cast("long").alias("at"),
            F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.length(m["gap"])).cast("long").alias("start"),
                (a["at"] + F.length(m["gap"]) + F.length(m["found"])).cast("long").alias("end"),
                m["found"].alias("found")))).alias("spans")))
    return done["spans"]


def base_entities(docs: DataFrame) -> DataFrame:
    """doc_id, text and the valid base matches of each kind (start, end, found)."""
    own = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    none = F.array().cast(_SPANS)
    return own.select("doc_id", "text", *[
        F.when(MAYBE[k](F.col("text")), F.filter(located(F.col("text"), PATTERNS[k]), _valid(k)))
        .otherwise(none).alias(k) for k in KINDS])


def _valid(kind: str):
    return lambda s: VALID[kind](s["found"])


def _with_context(text: Column, spans: Column, kind: str) -> Column:
    """The spans with their kind and the words before them (lower case, digits as #)."""
    def one(s: Column) -> Column:
        from_ = F.greatest(F.lit(0), s["start"] - _CONTEXT)
        before = F.substring(text, (from_ + 1).cast("int"), (s["start"] - from_).cast("int"))
        before = F.regexp_replace(F.lower(before), "[0-9]", "#")
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.lower(s["found"]).alias("instance"),
                        F.regexp_extract(before, r"(\S+)\s+[\"'(<\[]?$", 1).alias("one"),
                        F.regexp_extract(before, r"(\S+\s+\S+)\s+[\"'(<\[]?$", 1).alias("two"))
    return F.transform(spans, one)


def occurrences(docs: DataFrame) -> DataFrame:
    """row, doc_id and ``seen``: base entities and candidates (kind ``other``) with their contexts."""
    base = base_entities(docs)
    taken = F.concat(*KINDS)
    free = F.when(F.col("text").rlike(r"[0-9][._@+/A-Za-z-]*[0-9]"), F.filter(
        located(F.col("text"), _CANDIDATE),
        lambda s: (F.length(_digits(s["found"])) >= 6)
        & ~F.exists(F.col("taken"), lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))) \
        .otherwise(F.array().cast(_SPANS))
    own = base.withColumn("taken", taken).withColumn("other", free)
    return own.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                      F.concat(*[_with_context(F.col("text"), F.col(k), k) for k in (*KINDS, "other")]).alias("seen"))


def pattern_graph(seen: DataFrame) -> DataFrame:
    """pattern, instance, kind, n: documents in which the instance follows the pattern."""
    each = seen.select("doc_id", F.explode("seen").alias("s"))
    return each.select("doc_id", "s.kind", "s.instance", F.explode(F.array(
        F.concat(F.lit("1 "), "s.one"), F.concat(F.lit("2 "), "s.two"))).alias("pattern")) \
        .where(F.length("pattern") > 2).groupBy("pattern", "instance", "kind") \
        .agg(F.count_distinct("doc_id").alias("n"))


def confident_patterns(graph: DataFrame, rounds: int = 3, prior: float = 2.0, confident: float = 0.8) -> DataFrame:
    """pattern, kind, confidence of the patterns that end confident; at most one kind each."""
    seeds = graph.where("kind <> 'other'").select("pattern", "instance", "n", F.col("kind").alias("k"), F.lit(1.0).alias("w"))
    free = graph.where("kind = 'other'").select("pattern", "instance", "n")
    whole = graph.groupBy("pattern").agg(F.sum("n").alias("total"))
    shares = graph.where("kind <> 'other'").groupBy(F.col("kind").alias("k")).agg(F.sum("n").alias("of_kind")) \
        .crossJoin(F.broadcast(graph.agg(F.sum("n").alias("all"))))  # one row
    shares = shares.select("k", (F.col("of_kind") / F.col("all")).alias("share"))  # one row per kind
    weighted, best = seeds, None
    for step in range(rounds):
        scored = weighted.groupBy("pattern", "k").agg(F.sum(F.col("w") * F.col("n")).alias("weight")) \
            .join(whole, "pattern").join(F.broadcast(shares), "k") \
            .select("pattern", "k", ((F.col("weight") - F.col("total") * F.col("share"))
                                     / (F.col("total") * (1 - F.col("share")) + prior)).alias("confidence")) \
            .where(F.col("confidence") >= confident)
        best = written(scored.groupBy("pattern").agg(F.max_by(F.struct("k", "confidence"), F.struct("confidence", "k")).alias("b"))
                       .select("pattern", F.col("b.k").alias("k"), F.col("b.confidence").alias("confidence")), "pii-patterns")
        if step + 1 == rounds:
            break
        # candidates take the kinds of their confident patterns, and weigh in the next round
        known = free.join(best, "pattern").groupBy("instance", "k").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("w"))
        weighted = written(seeds.unionByName(free.join(known, "instance").select("pattern", "instance", "n", "k", "w")), "pii-weights")
    return best.select("pattern", F.col("k").alias("kind"), "confidence")


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, rounds: int = 3, prior: float = 2.0, confident: float = 0.8) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every whole text."""
    seen = written(occurrences(docs), "pii-seen")
    graph = written(pattern_graph(seen), "pii-graph")
    patterns = confident_patterns(graph, rounds, prior, confident)
    free = seen.select("row", F.explode(F.filter("seen", lambda s: s["kind"] == "other")).alias("s")).select(
        "row", "s.start", "s.end", F.explode(F.array(F.concat(F.lit("1 "), "s.one"), F.concat(F.lit("2 "), "s.two"))).alias("pattern"))
    found = free.join(patterns, "pattern").groupBy("row", "start", "end") \
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind")) \
        .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))  # of one document
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    own = seen.join(found, "row", "left").select(
        "doc_id", F.transform(F.filter("seen", lambda s: s["kind"] != "other"), plain).alias("base"),
        F.coalesce("more", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("more"))
    by_place = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        _order(s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), plain)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return own.select(
        "doc_id", *[number(k) for k in KINDS], F.sha2(_listed(by_place(F.col("base"))), 256).alias("base_sha256"),
        _listed(by_place(F.concat("base", "more"))).alias("spans"))
