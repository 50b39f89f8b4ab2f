"""Document fingerprints by SpotSigs, in DataFrame functions only.

A signature is a common word, the anchor, with the chain of the first `CHAIN` words
among the next `REACH` that are no anchors themselves.  One more anchor stands
before the first word, so every text with a word that is no anchor has a
signature; a text with signs but without words is its own signature.  Where `REACH`
or more words pass out of an anchor's reach (those before the first anchor are in
no anchor's), each of them stands in for an anchor, and so does each word of a text
without anchors; so no long part of a text goes without signatures, whatever its
language.  The fingerprint is the sorted set of the signatures' hashes.

Fingerprints are compared by Jaccard similarity.  `near_duplicates` partitions
them by length so that two alike ones lie in the same or in neighbouring
partitions, looks only at those that share one of their rarest signatures, and
prunes by length before it intersects.

Nulls: a null text is an empty one; its fingerprint is empty, and two empty ones
are alike (1).  A missing id is less than all others.  Rows with the same id and
text are one document in the order of documents and get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociflow.llm.common import written
from lociflow.llm.components import components

CHAIN = 2
REACH = 8
#: Buckets are compared in blocks of about so many members.
BLOCK = 512
#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their "
    "there they this to was we were which who will with you "
    "aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit "
    "nach nicht noch nur sich sie sind so über um und unter von vor war wie wir wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou où par pas pour "
    "plus qu que qui sa se ses son sont sur un une vous "
    "al como con del el ella ellos entre era esta este ha hay la las lo los más me mi muy no nos o para pero por que se "
    "ser si sin sobre su sus también un una y ya"
).split()
_ANCHORS = sorted(set(ANCHORS))
_FIRST = -(1 << 63)


def _with(value: Column, use) -> Column:
    """``use(value)``, where the value is made once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def signatures(text: Column) -> Column:
    """The fingerprint of a text: its signatures' hashes, distinct and in order."""
    text = F.coalesce(text, F.lit(""))

    def chain(ws: Column, start: Column) -> Column:
        return F.slice(F.filter(F.slice(ws, start, REACH), lambda w: ~w.isin(_ANCHORS)), 1, CHAIN)

    def signature(anchor: Column, ws: Column, start: Column) -> Column:
        return _with(chain(ws, start), lambda c: F.when(F.size(c) > 0, F.hash(anchor, c)))

    def stand_ins(ws: Column, places: Column) -> Column:
        def run(before: Column, end: Column) -> Column:
            start = before + REACH + 1
            here = (end - start >= REACH) | ((F.size(places) == 0) & (end > start))
            each = F.transform(F.sequence(start, end - 1), lambda i: F.hash(F.get(ws, i - 1), chain(ws, i + 1)))
            return F.when(here, each)

        ends = F.concat(places, F.array(F.size(ws) + 1))
        begins = F.concat(F.array(F.lit(-REACH)), places)
        return F.flatten(F.filter(F.zip_with(begins, ends, run), lambda r: r.isNotNull()))

    def found(ws: Column, places: Column) -> Column:
        first = F.array(signature(F.lit(""), F.filter(ws, lambda w: ~w.isin(_ANCHORS)), F.lit(1)))
        spots = F.transform(places, lambda i: signature(F.get(ws, i - 1), ws, i + 1))
        all_ = F.concat(first, spots, stand_ins(ws, places))
        return F.array_sort(F.array_distinct(F.filter(all_, lambda s: s.isNotNull())))

    def of(ws: Column) -> Column:
        places = F.filter(F.transform(ws, lambda w, i: F.when(w.isin(_ANCHORS), i + 1)), lambda i: i.isNotNull())
        return _with(places, lambda at: found(ws, at))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    made = _with(words, of)
    return F.when((F.size(made) == 0) & (text != ""), F.array(F.hash(text))).otherwise(made)


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Similarity of two fingerprints; 0, without a look at what they hold, if their lengths rule ``least`` out."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return (
        F.when(large == 0, F.lit(1.0))
        .when(small < least * large, F.lit(0.0))
        .otherwise(_with(both, lambda n: n / (F.size(a) + F.size(b) - n)))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """(k, th, text): what orders the documents, what tells those with the same id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("k"), F.xxhash64("text").alias("th"), "text")


def neighbours(marked: DataFrame) -> DataFrame:
    """(k, th, prev_k, prev_th, prev_n) of (k, th, n): who stands before each in descending order, in a ring.

    Ids are cut into ranges; only the first and last of each range, a small
    table, meet in one task.
    """
    one = marked.groupBy("k", "th").agg(F.min("n").alias("n"))
    ranged = one.repartitionByRange(F.desc("k"), F.desc("th")).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "doc-order")
    place = F.struct("k", "th", "n")
    ends = ranged.groupBy("part").agg(F.min(place).alias("last"))
    ring = Window.orderBy("part")
    carry = ends.select("part", F.coalesce(F.lag("last").over(ring), F.last("last").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("carry"))
    inside = Window.partitionBy("part").orderBy(F.desc("k"), F.desc("th"))
    found = ranged.select("part", "k", "th", F.lag(place).over(inside).alias("prev")).join(F.broadcast(carry), "part")
    prev = F.coalesce("prev", "carry")
    return found.select("k", "th", prev["k"].alias("prev_k"), prev["th"].alias("prev_th"), prev["n"].alias("prev_n"))


def fingerprints_and_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited form: its last third gives way to the beginning of the next document.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next); fingerprints are given as digests of their sets.
    """
    keyed = _keyed(docs)
    whole = F.coalesce("text", F.lit(""))
    prints = written(keyed.select("k", "th", F.length(whole).alias("n"), signatures(F.col("text")).alias("spots")), "fingerprints")
    order = written(neighbours(prints.select("k", "th", "n")), "doc-ring")
    # repeated rows have equal fingerprints
    once = prints.groupBy("k", "th").agg(F.first("spots").alias("spots"))
    # read twice with the same columns, so the texts are shuffled once
    texts = keyed.select("k", "th", whole.alias("text")).join(once, ["k", "th"])
    told = texts.join(order, ["k", "th"])
    sent = told.groupBy(F.col("prev_k").alias("k"), F.col("prev_th").alias("th")).agg(
        F.first(F.expr("substring(text, 1, cast(prev_n div 3 as int))")).alias("begin"), F.first("spots").alias("next_spots")
    )
    met = texts.join(sent, ["k", "th"])
    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(length(text) div 3 as int))"), F.col("begin"))
    doc_id = F.when(F.col("k") != _FIRST, F.col("k")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    made = met.select(doc_id, n.cast("long").alias("n_chars"), "spots", "next_spots", edited.alias("edited"))
    made = made.select(
        "doc_id", "n_chars", "spots", "next_spots", F.sha2("edited", 256).alias("edited_sha256"), signatures(F.col("edited")).alias("edited_spots")
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digest(F.col("spots")).alias("fingerprint"),
        digest(F.col("edited_spots")).alias("edited_fingerprint"),
        jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def digest(spots: Column) -> Column:
    """A fingerprint in short: its length and the md5 of its signatures."""
    return F.concat_ws("-", F.size(spots).cast("string"), F.md5(F.array_join(F.transform(spots, lambda s: s.cast("string")), " ")))


def _blocks(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members (d, rep, c, bucket, blocks) of buckets as left and right sides by (bucket, i, j): each pair of a bucket meets once."""
    placed = members.withColumn("own", F.pmod(F.xxhash64("d"), F.col("blocks")).cast("int"))
    last = F.col("blocks") - 1
    left = placed.select("bucket", F.col("own").alias("i"), F.explode(F.sequence("own", last)).alias("j"), F.col("d").alias("x"), F.col("rep").alias("a"), "c")
    right = placed.select("bucket", F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), F.col("d").alias("y"), F.col("rep").alias("b"), F.col("c").alias("f"))
    return left, right


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, n_spots, component_id) of every row: documents whose fingerprints reach ``least``, and chains of such.

    Equal fingerprints are one class.  A set shares one of its rarest signatures
    (its prefix) with every set alike enough; in each bucket of signature and
    length partition the members meet the smallest one, and then, across what are
    still different components, one another, block by block; only true links
    come out of a block.
    """
    spots = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text")).alias("spots")), "spots")
    usable = spots.filter("doc_id IS NOT NULL AND size(spots) > 0").withColumn("d", digest(F.col("spots")))
    classes = written(usable.groupBy("d").agg(F.min("doc_id").alias("rep"), F.first("spots").alias("spots")), "spot-classes")
    tokens = classes.select("d", "rep", F.size("spots").alias("n"), F.explode("spots").alias("s"))
    counted = tokens.join(tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df")), "s")
    ranked = counted.groupBy("d", "rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("by_df"))
    width = (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int")
    prefix = ranked.select("d", "rep", "n", F.explode(F.slice(F.col("by_df.s"), F.lit(1), width)).alias("s"))
    # alike sets lie in the same length partition or in the next one, where the shorter is entered, too
    part = F.floor(F.log("n") / -F.log(F.lit(least))).cast("int")
    entered = prefix.select("d", "rep", "n", F.explode(F.array(part, part + 1)).alias("part"), "s")
    buckets = entered.select("d", "rep", F.xxhash64("s", "part").alias("bucket"))

    def alike(pairs: DataFrame) -> DataFrame:
        one = classes.select(F.col("d").alias("x"), F.col("rep").alias("a"), F.col("spots").alias("p"))
        other = classes.select(F.col("d").alias("y"), F.col("rep").alias("b"), F.col("spots").alias("q"))
        both = pairs.join(one, "x").join(other, "y")
        return both.filter(jaccard(F.col("p"), F.col("q"), least) >= least - 1e-12).select("a", "b")

    hubs = buckets.groupBy("bucket").agg(F.min("d").alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    stars = buckets.join(hubs, "bucket").filter("d <> hub").select(F.col("hub").alias("x"), F.col("d").alias("y")).distinct()
    links = written(alike(stars), "spot-links")
    joined = components(links)
    placed = buckets.join(joined.withColumnRenamed("id", "rep"), "rep", "left").withColumn("c", F.coalesce("component", "rep"))
    mixed = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("d").alias("hub"))
    mixed = mixed.filter("m > 2 AND lo <> hi").select("bucket", "hub", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    open_ = placed.join(mixed, "bucket").filter("d <> hub").select("bucket", "blocks", "d", "rep", "c")
    left, right = _blocks(written(open_, "open-buckets"))
    left = left.join(classes.select(F.col("d").alias("x"), F.col("spots").alias("p")), "x")
    right = right.join(classes.select(F.col("d").alias("y"), F.col("spots").alias("q")), "y")
    met = left.join(right, ["bucket", "i", "j"]).filter("c <> f AND (i < j OR x < y)")
    more = written(met.filter(jaccard(F.col("p"), F.col("q"), least) >= least - 1e-12).select("a", "b"), "spot-links")
    joined = components(links.union(more))
    of_class = classes.join(joined.withColumnRenamed("id", "rep"), "rep", "left").select("d", F.coalesce("component", "rep").alias("component"))
    named = spots.withColumn("d", F.when(F.size("spots") > 0, digest(F.col("spots"))))
    return named.join(of_class, "d", "left").select(
        "doc_id", F.size("spots").cast("long").alias("n_spots"), F.coalesce("component", "doc_id").alias("component_id")
    )
