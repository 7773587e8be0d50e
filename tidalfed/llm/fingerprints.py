"""Operator 2: document fingerprints by consistent weighted sampling, DataFrame functions only.

Terms are pairs of neighbouring words (lower case), weighted by how often they occur. For a
term of weight w and a draw k, r and c are Gamma(2, 1) numbers and beta a uniform one, all
computed from hashes of (term, k): t = floor(ln w / r + beta), and the term's sample is
ln c - r (t - beta + 1). The least sample of a draw is the signature's value: two texts
agree in it when the same term at the same level t wins, which happens at the rate of their
generalized Jaccard similarity. A signature has ``PARTS`` x ``DRAWS`` values, and every term
takes part in each of them. A sample depends on the term, its weight and the draw only, so
terms are counted first, and a term that has the same weight in a text and in its edited form
is drawn once. Draws are rows of their own to keep the generated code short enough to be compiled.

Most samples are too large to be the least, which products alone show: with u1 u2 and u3 u4 the
numbers behind r and c, a sample is at least ln((1 - u3 u4) u1 u2 / w). Rows for which that is
above ln(``MOST`` / words of the text) are left out before any logarithm, and so are samples
above it. A draw's least sample is there with chance 1 - exp(-``MOST``), and then it is the true
one; a text with a draw that has none left gets all of its samples computed (``in_full``).

Fingerprints are 16 hex digits per value. Likeness is the share of equal values among those
that are not empty in both; two texts without terms are alike (1). Null texts count as
empty; rows without an id sort first. Rows with one id are ordered by text, and repeated
rows are rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidalfed.llm.common import whole_text, word_count

PARTS, DRAWS = 8, 8
#: Samples of a draw that are expected to be looked at closely; any number gives the same results.
MOST = 12.0
#: Bytes of text in one slice of the id order; slices are what tasks work on.
SLICE = 4 << 20
EMPTY = "-" * 16
BLANKS = " \t\n\x0b\f\r"


def product(seed: Column, term: Column, part: Column) -> Column:
    """The product of two numbers above 0 and below 1 from the halves of a hash."""
    one, two = uniforms(seed, term, part)
    return one * two


def uniforms(seed: Column, term: Column, part: Column) -> tuple[Column, Column]:
    """Two numbers above 0 and below 1 from the halves of a hash of the columns."""
    bits = F.xxhash64(term, part, seed)
    halves = F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit((1 << 32) - 1))
    return tuple((h.cast("double") + 0.5) / float(1 << 32) for h in halves)


def sample(term: Column, part: Column, seed: Column, log_weight: Column) -> Column:
    """The term's sample in the draw of a part that has the seeds from ``seed`` on."""
    r = -F.log(product(seed, term, part))
    c = -F.log(product(seed + 1, term, part))
    beta, _ = uniforms(seed + 2, term, part)
    level = F.floor(log_weight / r + beta)
    return F.log(c) - r * (level - beta + 1)


def slices(docs: DataFrame, slice_bytes: int) -> tuple[DataFrame, list[int | None]]:
    """Rows with ``_slice``, the number of their range of ids, and the ranges' lower bounds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, int(total // slice_bytes))
    shares = F.lit([i / number for i in range(1, number)] or [0.0])
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 100 * number)).first()[0] or []
    bounds = sorted(set(bounds)) if number > 1 else []
    # Bounds are one number per slice; ids at or above a bound lie in its slice.
    at = F.size(F.filter(F.lit(bounds or [0]).cast("array<long>"),
                         lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    return rows.withColumn("_slice", F.when(F.col("doc_id").isNull(), 0).otherwise(at)), bounds


def with_next(docs: DataFrame, slice_bytes: int) -> DataFrame:
    """Rows with the text of the next document, by slices whose last row sees a guest.

    The first row of each slice is also dealt, as a guest, to the slice before it (that of
    the first slice to the last), so that no slice but its own has to be read.
    """
    rows, bounds = slices(docs, slice_bytes)
    first = rows.groupBy("_slice").agg(F.min(F.struct("doc_id", "text")).alias("_first"))
    ring = Window.orderBy("_slice")  # one row per slice
    guests = first.select(
        "_first.doc_id", "_first.text",
        F.coalesce(F.lag("_slice").over(ring), F.max("_slice").over(
            ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .alias("_slice"), F.lit(True).alias("_guest"))
    dealt = rows.withColumn("_guest", F.lit(False)).unionByName(guests).repartition(
        len(bounds) + 1, "_slice")
    line = Window.partitionBy("_slice").orderBy("_guest", "doc_id", "text")
    return dealt.select("*", F.lead("text").over(line).alias("_next"),
                        F.row_number().over(line).alias("_place"))


def pairs(body: str) -> Column:
    """The words of a text with the one after each; the last word's is null."""
    # Without blanks at the ends no word is empty, but for a text without words.
    words = F.split(F.btrim(F.lower(body), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    return F.when(F.btrim(body, F.lit(BLANKS)) != "", F.arrays_zip(
        words.alias("one"), F.slice(words, F.lit(2), F.size(words)).alias("two")))


def value(least: Column) -> Column:
    """The 16 digits of a draw's least sample, null without one."""
    return F.when(least.isNotNull(), F.lower(F.lpad(F.hex(F.xxhash64(least)), 16, "0")))


def signatures(texts: DataFrame, parts: int, draws: int, most: float) -> DataFrame:
    """``_slice``, ``_place``, ``fingerprint``, ``edited_fingerprint``; no shuffle by term.

    Both are null for texts without terms, and where ``most`` leaves a draw without a sample.
    """
    few = F.greatest(F.least(word_count("text"), word_count("edited")), F.lit(1))
    terms = texts.select("_slice", "_place", few.alias("_words"), F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("_one")).select(
        "_slice", "_place", "_words", "_one.kind",
        F.explode(pairs("_one.body")).alias("pair")).select(
        "_slice", "_place", "_words", "kind",
        F.xxhash64("pair.one", "pair.two").alias("term"))
    # A text and its edited form share most terms: those of equal weight are drawn once.
    weighed = terms.groupBy("_slice", "_place", "_words", "term").agg(
        F.count_if(F.col("kind") == 0).alias("_w0"), F.count_if(F.col("kind") == 1).alias("_w1"))
    same = F.col("_w0") == F.col("_w1")
    once = lambda w, plain, other: F.struct(
        w.alias("weight"), F.lit(plain).alias("plain"), F.lit(other).alias("other"))
    each = F.when(same, F.array(once(F.col("_w0"), True, True))).otherwise(F.array(
        once(F.col("_w0"), True, False), once(F.col("_w1"), False, True)))
    limit = F.lit(float(most)) / F.col("_words")
    drawn = weighed.select("_slice", "_place", "_words", "term", F.explode(each).alias(
        "_one")).select("_slice", "_place", "_words", "term", "_one.*").filter(
        "weight > 0").select(
        "_slice", "_place", "_words", "term", F.log("weight").alias("log_weight"), "plain",
        # The bound is rounded otherwise than the samples: a little room, so that it stays one.
        "other", (limit * F.col("weight") * 1.000001).alias("_far"), F.inline(
            F.array(*(F.struct(F.lit(p).alias("part"), F.lit(3 * k).alias("seed"))
                      for p in range(parts) for k in range(draws)))))
    term, part, seed = F.col("term"), F.col("part"), F.col("seed")
    near = drawn.filter(product(seed, term, part) * (1 - product(seed + 1, term, part))
                        <= F.col("_far"))
    least = near.select(
        "_slice", "_place", "_words", "part", "seed", "plain", "other",
        sample(term, part, seed, F.col("log_weight")).alias("s")).groupBy(
        "_slice", "_place", "_words", "part", "seed").agg(
        *(F.min(F.when(F.col(form), F.col("s"))).alias(form) for form in ("plain", "other")))
    # Samples up to the limit are all there, so a least one up to it is the true one.
    forms = least.select("_slice", "_place", "part", "seed", *(
        F.when(F.col(form) <= F.log(limit), F.col(form)).alias(form)
        for form in ("plain", "other"))).groupBy("_slice", "_place", "part").agg(
        *(F.max(F.when(F.col("seed") == 3 * k, F.col(form))).alias(f"{form}{k}")
          for form in ("plain", "other") for k in range(draws)))
    named = forms.select("_slice", "_place", "part", *(
        F.concat(*(value(F.col(f"{form}{k}")) for k in range(draws))).alias(form)
        for form in ("plain", "other")))

    def joined(column: str) -> Column:
        return F.concat(*(F.max(F.when(F.col("part") == p, F.col(column)))
                          for p in range(parts)))

    return named.groupBy("_slice", "_place").agg(
        joined("plain").alias("fingerprint"), joined("other").alias("edited_fingerprint"))


def with_it(given: Column, make) -> Column:
    """``make(given)``, which is computed once however often ``make`` names it."""
    return F.element_at(F.transform(F.array(given), make), 1)


def in_full(body: str, parts: int, draws: int) -> Column:
    """A text's fingerprint from all of its samples, inside the row."""

    def weighed(hashes: Column) -> Column:
        number = F.size(hashes)
        starts = F.filter(F.sequence(F.lit(1), number), lambda i: (i == 1) | (
            F.element_at(hashes, F.greatest(i - 1, F.lit(1))) != F.element_at(hashes, i)))
        return with_it(starts, lambda at: F.transform(at, lambda start, i: F.struct(
            F.element_at(hashes, start).alias("term"),
            F.log((F.coalesce(F.get(at, i + 1), number + 1) - start).cast("long"))
            .alias("log_weight"))))

    def drawn(terms: Column) -> Column:
        each = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(3 * k).alias("seed"))
                         for p in range(parts) for k in range(draws)))
        return F.array_join(F.transform(each, lambda d: value(F.array_min(F.transform(
            terms, lambda t: sample(t["term"], d["part"], d["seed"], t["log_weight"]))))), "")

    hashes = F.sort_array(F.transform(pairs(body), lambda p: F.xxhash64(p["one"], p["two"])))
    return with_it(hashes, lambda h: with_it(weighed(h), drawn))


def likeness(a: str, b: str) -> Column:
    """Share of equal values among those that at least one side has."""
    # Cut into values once: finding one by its place goes through the string from the start.
    one, two = (F.regexp_extract_all(F.col(c), F.lit(f".{{{len(EMPTY)}}}"), F.lit(0))
                for c in (a, b))
    none = F.lit(EMPTY)
    found = F.zip_with(one, two, lambda x, y: F.when((x == none) & (y == none), F.lit(None))
                       .otherwise(x == y))
    known = F.filter(found, lambda same: same.isNotNull())
    return with_it(known, lambda same: F.when(F.size(same) > 0, F.size(F.filter(
        same, lambda x: x)) / F.size(same)).otherwise(F.lit(1.0)))


def fingerprints(docs: DataFrame, parts: int = PARTS, draws: int = DRAWS,
                 slice_bytes: int = SLICE, most: float = MOST) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                      F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    texts = with_next(docs, slice_bytes).withColumn("edited", edited)
    plain = texts.select("_slice", "_place", "_guest", "doc_id", n.cast("long").alias("n_chars"),
                         F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         "text", "edited")
    blank = F.lit(EMPTY * (parts * draws))
    line = Window.partitionBy("_slice").orderBy("_place")
    # Both parts of a row meet by a union, whose rows stay where they are: the window and the
    # aggregates share the dealing by slice, and texts are shuffled once.
    columns = [c for c in plain.columns if c not in ("_slice", "_place")]
    whole = plain.unionByName(
        signatures(texts, parts, draws, most), allowMissingColumns=True).groupBy(
        "_slice", "_place").agg(*(F.max(c).alias(c) for c in (
            *columns, "fingerprint", "edited_fingerprint")))

    def known(found: str, body: str) -> Column:
        return F.when(F.col(found).isNotNull(), F.col(found)).when(
            F.btrim(F.col(body), F.lit(BLANKS)) == "", blank).otherwise(
            in_full(body, parts, draws)).alias(found)

    joined = whole.select(
        "_slice", "_place", *(c for c in columns if c not in ("text", "edited")),
        known("fingerprint", "text"), known("edited_fingerprint", "edited")).withColumn(
        "_next_print", F.lead("fingerprint").over(line))
    return joined.filter(~F.col("_guest")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "_next_print").alias("near_next"))
