"""Benchmark decontamination over a positional inverted index, all in Spark.

A benchmark item is searched by its windows: ``size`` consecutive words, or
the whole item if it is shorter. Corpus counts of the test terms name the two
rarest words of each window. Postings of these words (term, document,
position; for the rarest also the words around it) are stored; the second list
is intersected with the first after moving both by their offsets in the
window, and the words around what is left tell exactly how far the phrase goes
on. Every occurrence of a window holds its rarest word, so none is missed.

Item tables are broadcast only if they are small (``BROADCAST_ROWS`` and
``BROADCAST_BYTES`` after a count); beyond that they are joined by shuffle, a
frequent word being dealt over ``SALTS`` partitions. What crosses a shuffle is
``(document, position, word)``; the words around a place are fetched by a join
with the texts afterwards, for the few places where both rare words of a window
are at their distance.

A window also matches in proximity: its two rarest words (of those that the
corpus has) lie at their distance give or take ``slop`` words, and of all its
words three in four, at least, lie within ``slop`` words of their place seen
from the rarest. An exact occurrence is a match in proximity, too. Proximity is
reported and does not count towards contamination.

Results: one row per input row. Null, empty and wordless texts have no words and
match nothing; long texts are searched whole. Items without words have no
windows, and an empty table of items hits nothing; an empty table of documents
gives no rows. Repeated documents get equal results; repeated items count once
per ``item_id``; a null ``item_id`` hits words but is not listed. Of equally rare
words the one further in front is the rarer (by its text if they share a place).
Other columns of any name do not matter; :func:`clean` keeps them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import stored

SIZE = 13
#: Words by which a word may be off its place in a match in proximity.
SLOP = 2
#: Rows, and bytes of their strings, of a table that is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
#: Partitions over which the rows of one word are dealt in a join by shuffle.
SALTS = 32
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered() -> Column:
    """The text with A-Z in lower case (``lower`` does only that to ASCII)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_between(mark: str) -> Column:
    """The words with ``mark``, itself a word, in front and behind: the text's
    own are at 1 to size - 2."""
    return F.split(F.concat(F.lit(mark + " "), lowered(), F.lit(" " + mark)), _SEPARATORS)


def item_words(items: DataFrame) -> DataFrame:
    """``(item_id, ih, ipos, term, n, all)``, each distinct item once."""
    w = F.filter(F.split(lowered(), _SEPARATORS), lambda x: x != "")
    return (items.select("item_id", F.xxhash64(lowered()).alias("ih"), w.alias("all")).dropDuplicates(["item_id", "ih"])
            .withColumn("n", F.size("all")).select("item_id", "ih", "n", "all", F.posexplode("all").alias("ipos", "term")))


def small(df: DataFrame) -> bool:
    """Whether a table of items fits a broadcast: its rows and its strings."""
    texts = [F.octet_length(F.col(c) if t == "string" else F.concat_ws(" ", c)) for c, t in df.dtypes if t in ("string", "array<string>")]
    each = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0)).cast("long")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("b")).first()
    return r["n"] <= BROADCAST_ROWS and r["b"] <= BROADCAST_BYTES


def hint(df: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(df) if broadcast else df


def by_term(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` joined with ``terms`` on ``term``: by a broadcast, or by a shuffle
    in which the rows of one term go to ``SALTS`` partitions."""
    if small(terms):
        return rows.join(F.broadcast(terms), "term")
    rows = rows.withColumn("salt", F.pmod(F.col("pos"), F.lit(SALTS)))
    dealt = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(dealt, ["term", "salt"]).drop("salt")


def free_word(vocab: DataFrame) -> str:
    """The shortest word of z's that is not in ``vocab`` (column ``term``)."""
    own = vocab.where(F.col("term").rlike("^z+$")).select(F.length("term").alias("n")).distinct()
    taken = {r["n"] for r in own.collect()}  # distinct lengths of words of one letter
    return "z" * next(n for n in range(1, len(taken) + 2) if n not in taken)


def rarest(item: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Windows' rarest and second rarest words of those in the corpus:
    ``(item_id, ih, p1, t1, p2, t2, starts)`` (``p2`` null if there is no second
    one), with the starts of the windows that share them."""
    known = item.join(counts, "term", "left")
    own = Window.partitionBy("item_id", "ih").orderBy("ipos").rowsBetween(0, size - 1)
    word = F.when(F.col("count") > 0, F.struct("count", "ipos", "term"))
    ranked = F.slice(F.sort_array(F.collect_list(word).over(own)), 1, 2)
    return (known.select("item_id", "ih", "ipos", "n", ranked.alias("r"))
            .where(F.col("ipos") + F.least(F.lit(size), F.col("n")) <= F.col("n")).where(F.size("r") > 0)
            .groupBy("item_id", "ih", F.col("r")[0]["ipos"].alias("p1"), F.col("r")[0]["term"].alias("t1"),
                     F.get("r", F.lit(1))["ipos"].alias("p2"), F.get("r", F.lit(1))["term"].alias("t2"))
            .agg(F.collect_set("ipos").alias("starts")))


def run_length(a: Column, b: Column) -> Column:
    """How many leading words of two lists agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False).cast("int")
    return F.when(stop > 0, stop - 1).otherwise(F.size(same))


class Index:
    """The stored postings that a set of items needs, and a row per document."""

    def __init__(self, docs: DataFrame, items: DataFrame, size: int = SIZE) -> None:
        self.size = size
        self.item = stored(item_words(items), "items")
        vocab = self.item.select("term").distinct()
        self.mark = free_word(vocab)
        self.texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
        every = self.texts.select(F.explode(words_between(self.mark)).alias("term"))
        if small(vocab):
            counts = every.join(F.broadcast(vocab), "term").groupBy("term").count()
        else:  # one row per term and task crosses the shuffle
            counts = every.groupBy("term").count().join(vocab, "term")
        self.pairs = stored(rarest(self.item, counts, size), "rarest")
        first = self.pairs.select(F.col("t1").alias("term"), F.lit(1).alias("seed"))
        second = self.pairs.where("t2 is not null").select(F.col("t2").alias("term"), F.lit(0).alias("seed"))
        terms = stored(first.union(second).groupBy("term").agg(F.max("seed").alias("seed")), "terms")
        places = self.texts.select("doc_id", "th", F.posexplode(words_between(self.mark)).alias("pos", "term"))
        self.postings = stored(by_term(places.where("pos > 0"), terms).select("doc_id", "th", "pos", "term", "seed"), "postings")

    def documents(self) -> DataFrame:
        """``(doc_id, th, n_words)`` of every row."""
        return self.texts.select("doc_id", "th", (F.size(words_between(self.mark)) - 2).cast("long").alias("n_words"))

    def _first_lists(self) -> DataFrame:
        """Postings of rarest words with the second word and its distance, each
        distinct (word, second word, distance) once, whatever windows share it."""
        keys = self.pairs.select(F.col("t1").alias("term"), "t2", (F.col("p2") - F.col("p1")).alias("apart")).distinct()
        return by_term(self.postings.where("seed = 1").drop("seed"), keys)

    def _second_lists(self) -> DataFrame:
        wanted = self.pairs.where("t2 is not null").select(F.col("t2").alias("term")).distinct()
        return by_term(self.postings.drop("seed"), wanted).select(
            F.col("doc_id").alias("_d"), F.col("th").alias("_h"), F.col("pos").alias("_p"), F.col("term").alias("_t"))

    def _windows(self, places: DataFrame) -> DataFrame:
        """The windows of the items that a place ``(term, t2, apart)`` may belong to."""
        pairs = self.pairs.select("item_id", "ih", "p1", "starts", F.col("t1").alias("_t1"), F.col("t2").alias("_t2"),
                                  (F.col("p2") - F.col("p1")).alias("_a"))
        return places.join(hint(pairs, small(pairs)), (places["term"] == pairs["_t1"]) & places["t2"].eqNullSafe(pairs["_t2"])
                           & places["apart"].eqNullSafe(pairs["_a"]))

    def _places(self, slop: int) -> DataFrame:
        """``(doc_id, th, pos, term, t2, apart, shift)``: places of a rarest word
        whose second word is ``shift`` words off its distance, at most ``slop``
        (the least of several). Positions are joined by cells as wide as the band."""
        first, second = self._first_lists(), self._second_lists()
        alone = first.where("t2 is null").withColumn("shift", F.lit(0)).distinct()
        first = first.where("t2 is not null").withColumn("at", F.col("pos") + F.col("apart"))
        same = first["doc_id"].eqNullSafe(second["_d"]) & (first["th"] == second["_h"]) & (first["t2"] == second["_t"])
        if slop == 0:
            met = first.join(second, same & (first["at"] == second["_p"]), "left_semi").withColumn("shift", F.lit(0)).distinct()
        else:
            wide = 2 * slop + 1
            cells = F.array(F.floor((F.col("at") - slop) / wide), F.floor((F.col("at") + slop) / wide))
            first = first.withColumn("cell", F.explode(F.array_distinct(cells)))
            second = second.withColumn("_c", F.floor(F.col("_p") / wide))
            shift = F.col("_p") - F.col("at")
            met = (first.join(second, same & (first["cell"] == second["_c"]))
                   .where(F.abs(shift) <= slop).where("_p <> pos")
                   .groupBy("doc_id", "th", "pos", "term", "t2", "apart")
                   .agg(F.min_by(shift, F.struct(F.abs(shift), shift)).alias("shift")))
        names = ["doc_id", "th", "pos", "term", "t2", "apart", "shift"]
        return stored(met.select(names).unionByName(alone.select(names)), "places")

    def _seen(self, slop: int) -> DataFrame:
        """Every place with each window group it may belong to, the words of the
        item (``all``, ``n``) and those of the document around the place
        (``before``, nearest first, and ``after``)."""
        places = self._places(slop)
        reach = F.lit(self.size - 1 + slop)
        per_doc = places.groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_h")).agg(
            F.collect_set(F.struct("pos", "term", "t2", "apart", "shift")).alias("at"))
        words, pos = F.col("words"), F.col("at.pos")
        near = (self.texts.join(hint(per_doc, small(places)),
                                self.texts["doc_id"].eqNullSafe(per_doc["_d"]) & (self.texts["th"] == per_doc["_h"]))
                .select("doc_id", "th", words_between(self.mark).alias("words"), F.explode("at").alias("at"))
                .select("doc_id", "th", pos.alias("pos"), "at.term", "at.t2", "at.apart", "at.shift",
                        F.reverse(F.slice(words, F.greatest(F.lit(2), pos - reach + 1),
                                          F.greatest(F.lit(0), F.least(reach, pos - 1)))).alias("before"),
                        F.slice(words, pos + 2, F.greatest(F.lit(0), F.least(reach, F.size(words) - 2 - pos))).alias("after")))
        both = self._windows(near)
        whole = self.item.where("ipos = 0").select(F.col("item_id").alias("_i"), F.col("ih").alias("_ih"), "n", "all")
        both = both.join(hint(whole, small(whole)), both["item_id"].eqNullSafe(whole["_i"]) & (both["ih"] == whole["_ih"]))
        p1 = F.col("p1")
        left = run_length(F.reverse(F.slice("all", F.greatest(F.lit(1), p1 - self.size + 2), F.least(F.lit(self.size - 1), p1))),
                          F.col("before"))
        right = run_length(F.slice("all", p1 + 2, F.lit(self.size - 1)), F.col("after"))
        return both.withColumn("left", left).withColumn("right", right)

    def _exact(self) -> Column:
        """Whether a row of ``_seen`` agrees with its item over a window."""
        return F.col("left") + F.col("right") + 1 >= F.least(F.lit(self.size), F.col("n"))

    def _near(self, slop: int) -> Column:
        """Whether three in four words of a window are within ``slop`` of their place."""
        around = F.concat(F.reverse("before"), F.array("term"), "after")
        here, n = F.size("before") + 1, F.least(F.lit(self.size), F.col("n"))

        def held(k: Column) -> Column:
            low = here + k - F.col("p1") - slop
            return F.array_contains(F.slice(around, F.greatest(F.lit(1), low), F.greatest(F.lit(0), F.least(F.lit(2 * slop + 1), low + 2 * slop))),
                                    F.get("all", k))

        return F.exists("starts", lambda s: 4 * F.size(F.filter(F.sequence(s, s + n - 1), held)) >= 3 * n)

    def _span(self) -> tuple[Column, Column]:
        return (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right") + 1).alias("end")

    def phrase_matches(self) -> DataFrame:
        """``(doc_id, th, item_id, start, end)``: runs of document words (from 1,
        end exclusive) that agree with an item over a window or more, at least
        one run over each occurrence of a window."""
        return self._seen(0).where(self._exact()).select("doc_id", "th", "item_id", *self._span())

    def proximity_matches(self, slop: int = SLOP) -> DataFrame:
        """``(doc_id, th, item_id, pos, shift)``: places (of the rarest word) at
        which a window matches in proximity; ``shift`` is how far its second word
        is off."""
        return self._seen(slop).where(self._near(slop)).select("doc_id", "th", "item_id", "pos", "shift").distinct()

    def matches(self, slop: int | None) -> DataFrame:
        """Per row with a match: ``doc_id, th, spans, items, near_items`` from one
        pass over the places (``near_items`` empty if ``slop`` is None)."""
        seen = self._seen(slop or 0)
        near = F.lit(False) if slop is None else self._near(slop)
        name = F.col("item_id").cast("string")
        seen = seen.select("doc_id", "th", name.alias("name"), F.struct(*self._span()).alias("span"),
                           self._exact().alias("exact"), near.alias("near")).where("exact or near")
        return seen.groupBy("doc_id", "th").agg(
            F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("span")))).alias("spans"),
            F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("name")))).alias("items"),
            F.sort_array(F.collect_set(F.when(F.col("near"), F.col("name")))).alias("near_items"))


def covered(spans: Column) -> Column:
    """Words under a sorted list of (start, end)."""
    zero = F.struct(F.lit(0).alias("done"), F.lit(0).alias("total"))
    return F.aggregate(
        spans, zero,
        lambda a, s: F.struct(F.greatest(a["done"], s["end"]).alias("done"),
                              (a["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["done"], s["start"]))).alias("total")),
        lambda a: a["total"])


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, slop: int | None = None) -> DataFrame:
    """Per row: ``doc_id, th, n_words, n_hit, items, contaminated, near_items``.
    Matches in proximity are looked for if ``slop`` is given."""
    index = Index(docs, items, size)
    hits = index.matches(slop).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_h"), covered(F.col("spans")).cast("long").alias("n_hit"),
        "items", "near_items")
    d = index.documents()
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<string>")
    return (d.join(hits, d["doc_id"].eqNullSafe(hits["_d"]) & (d["th"] == hits["_h"]), "left")
            .select("doc_id", "th", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
                    F.coalesce("near_items", none).alias("near_items")))


def digest(docs: DataFrame, items: DataFrame, size: int = SIZE, slop: int = SLOP) -> DataFrame:
    """The contract's columns, and the items that match in proximity:
    ``n_near_items, near_items_sha256``."""
    def joined(ids: str) -> Column:
        return F.sha2(F.array_join(ids, ",").cast("binary"), 256)

    return contamination(docs, items, size, slop).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), joined("items").alias("items_sha256"),
        "contaminated", F.size("near_items").cast("long").alias("n_near_items"), joined("near_items").alias("near_items_sha256"))


def clean(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """Stage: the rows that are not contaminated, with all their columns."""
    bad = (contamination(docs, items, size).where("contaminated")
           .select(F.col("doc_id").alias("_d"), F.col("th").alias("_h")).distinct())
    th = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_d"]) & (th == bad["_h"]), "left_anti")
