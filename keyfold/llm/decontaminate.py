"""Benchmark decontamination by a distributed positional inverted index.

``postings`` stores ``(term, doc_id, version, pos)`` for the words of whole
texts; ``version`` is a hash of the text, so that rows which share an id stay
apart.  A phrase is looked up from its rarest terms: the list of the rarest,
shifted by the term's offset, proposes starts; the shifted lists of the next
rarest keep those they hold as well; what is left is compared with the text
word by word.  Only the rare terms that some phrase is looked up by are
indexed unless all are asked for, so the most common words cost nothing.

DataFrame functions only.  Hot terms and passages: postings meet the phrases
in joins whose small side is broadcast while its measured size allows it (and
which adaptive execution splits beyond that); counts combine before shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm._spark import ascii_lower, stored

#: A run of separators: whatever isn't a digit, an ASCII letter or a non-ASCII character.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrase tables of at most so many rows are broadcast (some 200 bytes each).
BROADCAST_ROWS = 200_000
#: Tables of keys of rows (an id and a hash, some 80 bytes each in memory) of at most so many.
BROADCAST_KEYS = 1_000_000


def _words(text: Column) -> Column:
    """Words in order, capitals kept; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), "")


def _bounded(small: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    return F.broadcast(small) if rows <= (BROADCAST_ROWS if most is None else most) else small


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _positions(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", "version", F.posexplode(_words(F.col("text"))).alias("pos", "word"))
            .select("doc_id", "version", "pos", ascii_lower(F.col("word")).alias("term")))


def postings(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index ``term, doc_id, version, pos`` (0-based), of all words or of
    the distinct ``term`` rows given."""
    found = _positions(_keyed(docs, id_col, text_col))
    if terms is not None:
        terms = terms.select("term").distinct()
        found = found.join(_bounded(terms, terms.count()), "term")
    return found.select("term", "doc_id", "version", "pos")


def windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``phrase, words, items``: the distinct windows of ``size`` consecutive
    words (an item of fewer, but not none: the whole item) and their items."""
    words = items.select(F.col(id_col).cast("string").alias("item"), F.transform(_words(F.col(text_col).cast("string")), ascii_lower).alias("w"))
    last = F.greatest(F.size("w") - size, F.lit(0))
    each = (words.filter(F.size("w") > 0).select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
            .select("item", F.slice("w", F.col("at") + 1, F.lit(size)).alias("words")))
    return each.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("phrase", F.xxhash64(F.concat_ws(" ", "words")))


def phrase_matches(docs: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3) -> DataFrame:
    """``phrase, doc_id, version, start, len`` of every exact occurrence.

    ``phrases`` has ``phrase`` (a distinct key) and ``words``; ``depth`` lists
    are intersected before the comparison with the text.
    """
    keyed = _keyed(docs, id_col, text_col)
    offsets = phrases.select("phrase", F.size("words").alias("len"), F.posexplode("words").alias("offset", "term"))
    terms = offsets.select("term").distinct()
    n_terms = terms.count()
    # How common each test term is in the texts; absent terms count 0.
    counts = _positions(keyed).join(_bounded(terms, n_terms), "term").groupBy("term").agg(F.count("*").alias("n"))
    rare = Window.partitionBy("phrase").orderBy("n", "offset")
    ranked = (offsets.join(counts, "term", "left").fillna(0, ["n"])
              # the first occurrence of a term in its phrase stands for it
              .groupBy("phrase", "len", "term", "n").agg(F.min("offset").alias("offset"))
              .withColumn("rank", F.row_number().over(rare)).filter(F.col("rank") <= depth))
    # A phrase with a term that no text has can't occur.
    absent = ranked.filter("n = 0").select("phrase").distinct()
    ranked = stored(ranked.join(absent, "phrase", "left_anti"), "ranked")
    n_ranked = ranked.count()
    index = stored(postings(docs, ranked, id_col, text_col), "postings")

    found = None
    for rank in range(1, depth + 1):
        wanted = _bounded(ranked.filter(F.col("rank") == rank).select("phrase", "len", "offset", "term"), n_ranked)
        shifted = (index.join(wanted, "term").select("phrase", "len", "doc_id", "version", (F.col("pos") - F.col("offset")).alias("start"))
                   .filter("start >= 0"))
        if found is None:
            found = shifted
            continue
        # Phrases with fewer distinct terms than this rank have no further list.
        short = _bounded(ranked.groupBy("phrase").agg(F.max("rank").alias("lists")).filter(F.col("lists") < rank).select("phrase"), n_ranked)
        more = shifted.select("phrase", "doc_id", "version", "start")
        kept = _semi(found, more)
        found = kept.unionByName(found.join(short, "phrase", "left_semi"))
        found = found.distinct()
    found = stored(found, "candidates")

    # The comparison with the text, for texts that have candidates.
    here = found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("phrase", "start", "len")).alias("found"))
    keys = stored(found.select(F.col("doc_id").alias("kd"), F.col("version").alias("kv")).distinct(), "keys")
    if (n_keys := keys.count()) <= BROADCAST_KEYS:  # others' texts stay where they are
        keyed = keyed.join(_bounded(keys, n_keys, BROADCAST_KEYS), F.col("doc_id").eqNullSafe(F.col("kd")) & (F.col("version") == F.col("kv")), "left_semi")
    rows = keyed.join(here.withColumnRenamed("doc_id", "d").withColumnRenamed("version", "v"),
                      F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))).dropDuplicates(["doc_id", "version"])
    each = (rows.select("doc_id", "version", "found", F.transform(_words(F.col("text")), ascii_lower).alias("w"))
            .select("doc_id", "version", F.explode(F.transform("found", lambda f: F.struct(
                f["phrase"].alias("phrase"), f["start"].alias("start"), f["len"].alias("len"),
                F.slice(F.col("w"), f["start"] + 1, f["len"]).alias("words")))).alias("f"))
            .select("doc_id", "version", "f.*"))
    n_phrases = phrases.count()
    return (each.join(_bounded(phrases.select("phrase", "words"), n_phrases), ["phrase", "words"])
            .select("phrase", "doc_id", "version", "start", "len"))


def _semi(left: DataFrame, right: DataFrame) -> DataFrame:
    r = right.select(F.col("phrase").alias("p"), F.col("doc_id").alias("d"), F.col("version").alias("v"), F.col("start").alias("s"))
    return left.join(r, (F.col("phrase") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d"))
                     & (F.col("version") == F.col("v")) & (F.col("start") == F.col("s")), "left_semi")


def proximity_matches(docs: DataFrame, phrases: DataFrame, slop: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``phrase, doc_id, version, pos``: occurrences of a phrase's rarest term
    with every other term of the phrase at most ``slop`` words away, in any order.

    Positions meet in buckets of ``slop + 1`` words and their neighbours.
    """
    terms = phrases.select("phrase", F.explode(F.array_distinct("words")).alias("term"))
    index = stored(postings(docs, terms, id_col, text_col), "postings")
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    rank = Window.partitionBy("phrase").orderBy("n", "term")
    ranked = stored(terms.join(counts, "term", "left").fillna(0, ["n"]).withColumn("rank", F.row_number().over(rank))
                    .withColumn("others", F.count("*").over(Window.partitionBy("phrase")) - 1), "ranked")
    n = ranked.count()
    centre = (index.join(_bounded(ranked.filter("rank = 1").select("phrase", "term", "others"), n), "term")
              .select("phrase", "others", "doc_id", "version", F.col("pos").alias("centre")))
    bucket = F.floor(F.col("centre") / (slop + 1))
    asked = centre.withColumn("bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    others = (index.join(_bounded(ranked.filter("rank > 1").select("phrase", "term"), n), "term")
              .select(F.col("phrase").alias("p"), "term", F.col("doc_id").alias("d"), F.col("version").alias("v"), "pos",
                      F.floor(F.col("pos") / (slop + 1)).alias("b")))
    near = (asked.join(others, (F.col("phrase") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v"))
                       & (F.col("bucket") == F.col("b")) & (F.abs(F.col("pos") - F.col("centre")) <= slop))
            .groupBy("phrase", "doc_id", "version", "centre", "others").agg(F.countDistinct("term").alias("seen"))
            .filter("seen = others"))
    alone = centre.filter("others = 0")
    out = ["phrase", "doc_id", "version", F.col("centre").alias("pos")]
    return near.select(*out).unionByName(alone.select(*out))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", size: int = 13, share: int = 20,
                  with_version: bool = False) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, a row per input row.

    A null or wordless text has no words and is clean; so are all texts when
    there are no items.  Items with null or wordless texts have no windows;
    items that share a window all count.  Rows that repeat an id are judged
    each by its own text.  Null ids are kept as such.  Other columns are ignored.
    """
    phrases = stored(windows(items, item_col, item_text, size), "phrases")
    # An empty set of phrases still gives rows, all clean.
    found = phrase_matches(docs, phrases, id_col, text_col)
    found = stored(found, "found")
    spans = found.groupBy("doc_id", "version", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = F.max("end").over(Window.partitionBy("doc_id", "version").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    hit = (spans.withColumn("before", F.coalesce(before, F.lit(0)))
           .groupBy("doc_id", "version").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).cast("long").alias("n_hit")))
    named = (found.select("doc_id", "version", "phrase").distinct()
             .join(_bounded(phrases.select("phrase", "items"), phrases.count()), "phrase")
             .select("doc_id", "version", F.explode("items").alias("item"))
             .groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("item")).alias("items")))
    marks = (hit.withColumnsRenamed({"doc_id": "d", "version": "v"})
             .join(named, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("v") == F.col("version")), "left").select("d", "v", "n_hit", "items"))
    rows = _keyed(docs, id_col, text_col).select("doc_id", "version", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("version") == F.col("v")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", *["version"] * with_version, "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                      ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``), all columns, without contaminated rows.

    Texts stay where they are while at most ``BROADCAST_KEYS`` keys are contaminated.
    """
    bad = stored(contamination(docs, items, with_version=True).filter("contaminated").select("doc_id", "version").distinct(), "contaminated")
    bad = _bounded(bad, bad.count(), BROADCAST_KEYS)
    # Aliases: the documents may have columns of these names.
    same = F.col("own.doc_id").eqNullSafe(F.col("bad.doc_id")) & (F.xxhash64(F.col("own.text").cast("string")) == F.col("bad.version"))
    return docs.alias("own").join(bad.alias("bad"), same, "left_anti")
