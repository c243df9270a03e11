"""Personal data by bootstrapped contextual extraction, in DataFrame operations.

The base patterns find e-mail addresses, IP addresses, card numbers and phone
numbers.  They are the seeds.  Every text is read once into a compact table:
its base spans, and its *identifiers* (runs of tokens with a digit or an at
sign) with the words to the left and right.  What follows works on that table:

1. Each identifier occurrence is an edge between an *instance* (its value) and
   its *patterns*: the words around it, lower-cased and without their
   punctuation (the first and the second on each side, the first on both, the
   first two on one side), and each of the nearest words with the shape of the
   value (letters, digits, other signs).
2. A pattern's confidence for a kind is the summed score of its instances of
   that kind over the weight of all its instances; seeds have score and weight
   1, found ones weigh 1 with their score, and unknown ones weigh ``doubt``,
   as they may be what is looked for.  Patterns of at least ``min_support`` positive instances
   and ``min_confidence`` are kept.
3. An unknown instance's score is the confidence of the best kept pattern it
   occurs in, if its length and share of digits look like the kind's.
   Steps 2 and 3 repeat for ``rounds`` rounds, so that instances found bring
   in new patterns.

The counts are partial-aggregated sums over distinct edges; no group is
collected, and nothing but the number of rounds is bounded.  What is found is
broadcast to the occurrences up to BROADCAST_FOUND rows (counted); beyond, a
value that very many rows have is left to the skewed join of the adaptive
plan.

Defined results: NULL text counts as empty; repeated rows get equal spans;
spans are in code points.  Offsets follow from splitting the text at the
matches and summing lengths, so they are right for any characters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import pick
from folioflow.session import shared_dir

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  A leading look-behind (or the end of the match before)
# keeps a search from starting anew inside a run that has already failed, and
# possessive repeats keep it from going back: the matches are the same.
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no match
# Tokens with a digit or an at sign, joined by single spaces.
TOKEN = r"[^\s0-9@]*+[0-9@]\S*+"
IDENTIFIER = rf"(?<!\S){TOKEN}(?:\x20{TOKEN})*+"
CHUNK = 256  # matches that are placed together: a text may have very many
BROADCAST_FOUND = 100_000  # instances (under 200 bytes each) that may be broadcast


CONTEXT = 3  # words (or signs) on each side of an identifier that are looked at


@dataclass(frozen=True)
class Bootstrap:
    """Limits of the bootstrap."""

    rounds: int = 3
    min_support: int = 5
    min_confidence: float = 0.8
    min_instance: float = 0.8
    doubt: float = 0.5  # what an unknown instance counts against a pattern; one of another kind counts whole
    length_slack: float = 0.5  # share by which a value may be shorter or longer than the seeds of its kind
    digit_slack: float = 0.25  # by which its share of digits may be out of their range


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the matches of ``pattern``, in code points.

    Matches are placed in chunks, then the chunks one after the other, so the
    cost grows with their number and not with its square.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    spans = "array<struct<start:int,end:int,value:string>>"

    def start() -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["gap"]
        end = at + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(at.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    def behind(acc: Column, chunk: Column) -> Column:
        moved = F.transform(chunk["out"], lambda m: F.struct((m["start"] + acc["at"]).alias("start"), (m["end"] + acc["at"]).alias("end"), m["value"].alias("value")))
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("out"))

    def placed(p: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(p), F.lit(1)), F.lit(CHUNK))
        chunks = F.transform(firsts, lambda k: F.aggregate(F.slice(p, k, F.lit(CHUNK)), start(), step))
        return F.flatten(F.aggregate(chunks, none, behind, lambda acc: acc["out"]))

    return _once(pairs, placed)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once although ``use`` has it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.split(F.reverse(_digits(value)), "")
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) < 4) & F.forall(
            F.split(value, r"\."), lambda p: F.substring(F.concat(F.lit("000"), p), -3, 3).cast("int") <= 255
        )
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _base(text: Column, kind: str) -> Column:
    """Array of (start, end, value) of the valid base matches of a kind."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
    some = F.when(hint, F.regexp_like(text, F.lit(PATTERNS[kind].replace(r"\G|", "")))).otherwise(F.lit(False))
    return F.when(some, F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))).otherwise(none)


def _seed_kind(value: Column) -> Column:
    """The first kind that has a valid base match inside an identifier."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        inside = F.exists(F.regexp_extract_all(value, F.lit(PATTERNS[kind]), F.lit(0)), lambda v: _valid(kind, v))
        out = F.when(inside, F.lit(kind)).otherwise(out)
    return out


def _words(context: Column) -> Column:
    """The words of a context, lower-cased and without punctuation; signs alone are no word."""
    return F.regexp_extract_all(F.lower(context), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))


def _patterns(value: Column, left: Column, right: Column) -> Column:
    """The patterns that an occurrence is an instance of."""
    near, far = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2))
    after, later = F.try_element_at(right, F.lit(1)), F.try_element_at(right, F.lit(2))
    shape = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]+", "0")
    every = F.array(
        F.concat(F.lit("L|"), near), F.concat(F.lit("LL|"), far), F.concat_ws("|", F.when(far.isNotNull(), F.lit("LB")), far, near),
        F.concat(F.lit("R|"), after), F.concat(F.lit("RR|"), later), F.concat_ws("|", F.when(later.isNotNull(), F.lit("RB")), after, later),
        F.when(near.isNotNull() & after.isNotNull(), F.concat_ws("|", F.lit("B"), near, after)),
        F.concat(F.lit("LS|"), near, F.lit("|"), shape), F.concat(F.lit("RS|"), after, F.lit("|"), shape),
    )
    return F.filter(every, lambda p: p.rlike("^[A-Z]+[|]"))


def _marks(docs: DataFrame) -> DataFrame:
    """One row for each document: base spans, and identifiers with their context words."""
    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, doc_id="long", text="string").select("doc_id", text.alias("text"))
    spaced = F.translate("text", "\t\n\r\x0b\x0c", "     ")
    both = F.struct(_matches(spaced, IDENTIFIER).alias("found"), F.split(spaced, IDENTIFIER, -1).alias("pieces"))

    def in_context(held: Column) -> Column:
        # the nearest words on each side, up to the identifier before or after
        return F.transform(
            held["found"],
            lambda m, i: F.struct(
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["value"].alias("value"),
                _words(F.substring_index(F.rtrim(F.get(held["pieces"], i)), " ", -CONTEXT)).alias("left"),
                _words(F.substring_index(F.ltrim(F.get(held["pieces"], i + 1)), " ", CONTEXT)).alias("right"),
            ),
        )

    identifiers = _once(both, in_context)
    none = F.array().cast("array<struct<start:int,end:int,value:string,left:array<string>,right:array<string>>>")
    has = F.regexp_like("text", F.lit("[0-9@]"))
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        *[F.when(has, _base(F.col("text"), k)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>")).alias(k) for k in KINDS],
        F.when(has, identifiers).otherwise(none).alias("identifiers"),
    )


def _edges(marks: DataFrame) -> DataFrame:
    """Distinct (pattern, instance) edges, with the instance's seed kind and shape."""
    seen = marks.select(F.explode("identifiers").alias("m")).select(
        F.col("m.value").alias("instance"), F.col("m.left").alias("left"), F.col("m.right").alias("right")
    )
    seen = seen.groupBy("instance", "left", "right").agg(F.lit(1).alias("one")).drop("one")
    return seen.select(
        "instance",
        _seed_kind(F.col("instance")).alias("seed"),
        F.explode(_patterns(F.col("instance"), F.col("left"), F.col("right"))).alias("pattern"),
    )


def discover(edges: DataFrame, limits: Bootstrap = Bootstrap()) -> DataFrame:
    """(instance, kind, score) of the instances found beyond the seeds.

    ``edges``: (instance, seed, pattern); an edge may be repeated.
    """
    edges = edges.groupBy("instance", "pattern").agg(F.max("seed").alias("seed"))
    shape = F.length(_digits(F.col("instance"))) / F.greatest(F.length("instance"), F.lit(1))
    shapes = (
        edges.where("seed is not null")
        .groupBy("seed")
        .agg(
            F.min(F.length("instance")).alias("least"),
            F.max(F.length("instance")).alias("most"),
            F.min(shape).alias("low"),
            F.max(shape).alias("high"),
        )
        .withColumnRenamed("seed", "kind")
    )  # a row for each kind
    scored = edges.select("instance", "pattern", F.col("seed").alias("kind"), F.when(F.col("seed").isNotNull(), 1.0).otherwise(0.0).alias("score"))
    found = None
    for _ in range(limits.rounds):
        sums = [F.sum(F.when(F.col("kind") == k, F.col("score"))).alias(f"score_{k}") for k in KINDS]
        counts = [F.count(F.when(F.col("kind") == k, True)).alias(f"n_{k}") for k in KINDS]
        weight = F.sum(F.when(F.col("kind").isNull(), limits.doubt).otherwise(1.0))
        totals = scored.groupBy("pattern").agg(weight.alias("n"), *sums, *counts)
        kept = totals.select(
            "pattern",
            F.explode(
                F.array(*[F.struct(F.lit(k).alias("kind"), (F.col(f"score_{k}") / F.col("n")).alias("confidence"), F.col(f"n_{k}").alias("support")) for k in KINDS])
            ).alias("k"),
        ).select("pattern", "k.*")
        kept = kept.where((F.col("support") >= limits.min_support) & (F.col("confidence") >= limits.min_confidence))
        unknown = edges.where("seed is null").select("instance", "pattern")
        near = unknown.join(kept, "pattern").join(F.broadcast(shapes), "kind")
        long_enough = F.length("instance").between(F.col("least") * (1 - limits.length_slack), F.col("most") * (1 + limits.length_slack))
        near = near.where(long_enough & shape.between(F.col("low") - limits.digit_slack, F.col("high") + limits.digit_slack))
        best = near.groupBy("instance").agg(F.max(F.struct("confidence", "kind")).alias("b"))
        found = best.where(F.col("b.confidence") >= limits.min_instance).select("instance", F.col("b.kind").alias("kind"), F.col("b.confidence").alias("score"))
        found = found.checkpoint()
        base = edges.join(found.withColumnsRenamed({"kind": "new_kind", "score": "new_score"}), "instance", "left")
        scored = base.select(
            "instance",
            "pattern",
            F.coalesce("seed", "new_kind").alias("kind"),
            F.when(F.col("seed").isNotNull(), 1.0).otherwise(F.coalesce("new_score", F.lit(0.0))).alias("score"),
        )
    return found


def find_personal_data(docs: DataFrame, limits: Bootstrap = Bootstrap()) -> DataFrame:
    """Counts and spans of personal data in each row of ``docs`` (``doc_id``, ``text``)."""
    shared_dir(docs.sparkSession)
    marks = _marks(docs).checkpoint()
    edges = _edges(marks).checkpoint()
    found = discover(edges, limits)

    occurrences = (
        marks.where(F.size("identifiers") > 0)
        .select("doc_id", "text_key", F.explode("identifiers").alias("m"))
        .select("doc_id", "text_key", F.col("m.value").alias("instance"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))
    )
    few = F.broadcast(found) if found.count() <= BROADCAST_FOUND else found
    more = occurrences.join(few, "instance").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("kind", "start", "end")).alias("more")
    )
    more = more.withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"})
    rows = marks.join(more, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")

    def ranked(spans: Column, kind: str | None = None) -> Column:
        k = (lambda s: F.lit(kind)) if kind else (lambda s: s["kind"])
        rank = lambda s: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k(s))
        return F.transform(spans, lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), k(s).alias("kind")))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.concat(*[ranked(F.col(k), k) for k in KINDS])
    extra = ranked(F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    rows = rows.withColumn("base", base).withColumn("extra", extra)
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "extra")).alias("spans"),  # what is found has no base match in it, so none comes twice
        F.size("extra").cast("long").alias("n_found"),
    )
