"""Line dedup by a log-template tree, in SQL functions only.

A line is parsed to a template by a tree of fixed depth:

* tokens are what stands between white space, and every sign of a script
  that is written without it (Chinese, Japanese, Thai and others); a token
  with a digit is a variable field, written ``<*>`` (the *masked* line);
* a line has as many words as tokens (``SIGNS_A_WORD`` such signs count as
  one), but at least one for ``CHARS_A_WORD`` characters; it is long if it has
  at least ``long_tokens``;
* the leaf of a line is its token count and its first ``depth`` masked tokens;
* within a leaf, for long lines, the support of a
  token is the number of distinct masked lines that have it at its place.  A
  line is generalised if at least ``min_constant`` of its tokens have a support
  above 1; of the best supported tokens that make up this part, the last one
  sets the measure, and a token with less than half its support is a variable
  field too.  The measure grows with the leaf, so a field whose values come
  back in a large corpus stays a field (but a value that more lines of the
  leaf have than half of a rare template's own lines counts as constant there).

The template generalised by the leaf counts if there is one, else the masked
line if at least ``min_masked`` of its tokens are constant, else the line
itself.  A template that occurs in at least ``min_docs`` documents
(``min_docs_short`` for lines that are not long) is recurring; so are, from
``min_docs`` documents on, the short lines of a passage: of consecutive short
lines of ``RUN_WORDS`` words, or of consecutive recurring lines with
``PASSAGE_WORDS`` words in short ones.  Blank lines do not count.  Recurring
lines stay in the document with the smallest id and are dropped from all
others, so one copy of a repeated passage survives and a document that repeats
nothing is left as it is.

Texts are parsed once.  Lines travel as hashes; the masked text of long lines
lies beside them, and only that of leaves that hold several distinct masked
lines is read again, each distinct one once.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from .common import materialize

FIELD = "<*>"
# signs of scripts written without blanks: each is a token
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\u30fc\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
# white space beyond ASCII (the Unicode separators, next line)
WIDE_SPACE = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE = rf"[\x80-\uffff&&[{WIDE_SPACE}]]"    # the same, ASCII told apart in one comparison
SIGNS_A_WORD = 3                # and so many of them are as long as a word
CHARS_A_WORD = 10               # a line has at least one word for so many characters
RUN_WORDS = 16                  # words of a run of short lines that recur together
PASSAGE_WORDS = 50              # words in short lines of a passage that has long lines too
SMALL_TABLE = 16 << 20          # a written table of at most this size (in bytes) may be broadcast


def _parsed(docs: DataFrame, depth: int, long_tokens: int) -> DataFrame:
    """``(doc_id, pos, n, words, leaf, form, raw, n_var, masked)`` per
    non-blank line; ``masked`` is null for lines that are not long.

    White space, signs and fields are rewritten in whole texts, each only where
    a test of the text says that there is something to do, and the lines are
    cut afterwards.  The outer generator keeps Spark from deriving a filter
    that would evaluate all of this a second time."""
    text = F.col("text")
    ascii_only = F.octet_length(text) == F.length(text)
    uneven = functools.reduce(lambda a, b: a | b, [text.contains(x) for x in ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\f")],
                              text.startswith(" ") | text.endswith(" ")) | (~ascii_only & text.rlike(WIDE))
    even = F.btrim(F.regexp_replace(F.regexp_replace(text, f"[ \t\x0b\f\r{WIDE_SPACE}]+", " "), " ?\n ?", "\n"), F.lit(" "))
    far = ~ascii_only & text.rlike("[^\\x00-\\u0dff\\u2000-\\u2bff]")              # beyond the scripts with blanks: look closer
    out = docs.select("doc_id", F.when(uneven, even).otherwise(text).alias("plain"), far.alias("far"))
    out = out.select("*", (F.col("far") & F.col("plain").rlike(UNSPACED)).alias("unspaced"))
    apart = F.regexp_replace("plain", f" ?({UNSPACED}) ?", " $1 ")
    apart = F.btrim(F.regexp_replace(F.regexp_replace(apart, " +", " "), " ?\n ?", "\n"), F.lit(" "))
    out = out.select("doc_id", "plain", "unspaced", F.when(F.col("unspaced"), apart).otherwise(F.col("plain")).alias("text"))
    masked = F.regexp_replace("text", r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", FIELD)
    out = out.select("doc_id", "unspaced", "text", F.when(F.col("text").rlike("[0-9]"), masked).alias("masked"), "plain")
    # cut only where it differs from the text
    lines = lambda c, where: F.when(where, F.split(c, "\n")).otherwise(F.array().cast("array<string>"))
    zipped = F.arrays_zip(F.split("text", "\n").alias("line"), lines("masked", F.col("masked").isNotNull()).alias("masked"),
                          lines("plain", F.col("unspaced")).alias("plain"))
    out = out.select("doc_id", F.posexplode_outer(zipped).alias("pos", "l")) \
             .select("doc_id", "pos", F.col("l.line").alias("line"), F.coalesce("l.masked", "l.line").alias("masked"), F.col("l.plain").alias("plain"))
    out = out.filter("line != ''")
    signs = F.when(F.col("plain").isNotNull(), F.length("plain") - F.length(F.regexp_replace("plain", UNSPACED, ""))).otherwise(0)
    blanks = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit("")))
    fields = F.when(F.col("line") != F.col("masked"), F.size(F.split("masked", r"(?<![^ ])<\*>(?![^ ])")) - 1).otherwise(0)
    out = out.select("doc_id", "pos", "line", "masked", signs.alias("signs"), (blanks + 1).alias("n"),
                     F.length(F.coalesce("plain", "line")).alias("chars"), fields.alias("n_var"))
    words = F.greatest(F.expr(f"n - signs + signs div {SIGNS_A_WORD}"), F.expr(f"chars div {CHARS_A_WORD}"), F.lit(1)).cast("int")
    return out.select("doc_id", "pos", "n", words.alias("words"), F.xxhash64("n", F.substring_index("masked", " ", depth)).alias("leaf"),
                      F.xxhash64("masked").alias("form"), F.xxhash64("line").alias("raw"), "n_var",
                      F.when(words >= long_tokens, F.col("masked")).alias("masked"))


def _generalised(lines: DataFrame, long_tokens: int, min_constant: float) -> DataFrame:
    """``(leaf, form, template)`` for the lines whose leaf generalises them."""
    long = lines.filter(F.col("words") >= long_tokens)
    forms = long.groupBy("leaf", "form").agg(F.count(F.lit(1)).alias("_c"))
    leaves = forms.groupBy("leaf").agg(F.count(F.lit(1)).alias("forms")).filter("forms > 1").select("leaf")
    leaves = materialize(leaves, "leaves")
    # the form stands for the masked line: one row for each, grouped by plain keys
    texts = long.select("leaf", "form", "n", "masked").join(broadcast_if_small(leaves, SMALL_TABLE), "leaf", "left_semi").distinct()
    tokens = materialize(texts.select("leaf", "form", "n", F.posexplode(F.split("masked", " ")).alias("at", "token"))
                              .filter(F.col("token") != FIELD)
                              .select("leaf", "form", "n", F.xxhash64("at", "token").alias("token")), "tokens")
    support = tokens.groupBy("leaf", "token").agg(F.count(F.lit(1)).alias("support")).filter("support > 1")
    held = (tokens.join(support, ["leaf", "token"]).groupBy("leaf", "form")
                  .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("support", "token")), asc=False).alias("held"))
                  .withColumn("need", F.ceil(min_constant * F.col("n")).cast("int")).filter(F.size("held") >= F.col("need")))
    held = held.withColumn("least", F.get("held", F.col("need") - 1)["support"])
    constant = F.filter("held", lambda t: t["support"] * 2 >= F.col("least"))
    return held.select("leaf", "form", F.xxhash64("leaf", F.transform(constant, lambda t: t["token"])).alias("template"))


def _recurring_runs(keyed: DataFrame, templates: DataFrame, long_tokens: int, min_docs: int) -> DataFrame:
    """``(doc_id, pos)`` of the short lines in recurring runs.

    All lines of a run have templates of ``min_docs`` documents (``templates``).
    A run is as few short lines as have ``RUN_WORDS`` words, one after the
    other, or ``PASSAGE_WORDS``, with any long lines between them; it is
    counted from every line on and back from every line.  Runs of templates
    that recur alone are left out, so a run is in fewer documents than the
    rarest of its templates may be.
    """
    t = templates.select("template", "alone")
    order = Window.partitionBy("doc_id").orderBy("pos", "template")
    same = (F.lag("pos").over(order) == F.col("pos")) & (F.lag("template").over(order) == F.col("template"))
    long = F.col("words") >= long_tokens
    ends = lambda c: F.sum(c.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    lines = (keyed.join(broadcast_if_small(t, SMALL_TABLE), "template", "left")
                  .withColumn("_same", F.coalesce(same, F.lit(False)))
                  .withColumn("_rare", F.max(F.coalesce(~F.col("alone") & ~long, F.lit(False))).over(Window.partitionBy("doc_id")))
                  .withColumn("_passage", ends(F.col("alone").isNull())).withColumn("_run", ends(F.col("alone").isNull() | long))
                  .filter("_rare AND NOT _same AND alone IS NOT NULL").filter(~long))
    lines = materialize(lines.select("doc_id", "pos", "template", "words", "alone", "_run", "_passage"), "short")
    runs = []
    for part, least in (("_run", RUN_WORDS), ("_passage", PASSAGE_WORDS)):
        for seed, rows in ((least, order.rowsBetween(0, least - 1)), (-least, order.rowsBetween(1 - least, 0))):
            near = F.collect_list(F.struct(F.col(part).alias("part"), "template", "words", "alone", "pos")).over(rows)
            start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"), F.lit(False).alias("rare"), F.lit(seed).cast("bigint").alias("key"))
            found = F.aggregate("_near", start, lambda a, x: F.when((a["words"] >= least) | (x["part"] != F.col(part)), a).otherwise(  # noqa: B023
                F.struct((a["words"] + x["words"]).alias("words"), (a["lines"] + 1).alias("lines"), (a["rare"] | ~x["alone"]).alias("rare"),
                         F.xxhash64(a["key"], x["template"]).alias("key"))))
            runs.append(lines.withColumn("_near", near if seed > 0 else F.reverse(near)).withColumn("_found", found)
                             .filter((F.col("_found.words") >= least) & F.col("_found.rare"))
                             .select("doc_id", F.col("_found.key").alias("key"),
                                     F.slice(F.transform("_near", lambda x: x["pos"]), 1, F.col("_found.lines")).alias("places")))
    runs = materialize(runs[0].unionByName(runs[1]).unionByName(runs[2]).unionByName(runs[3]), "runs")
    first = (runs.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("first"))
                 .filter(F.col("docs") >= min_docs).select("key", "first"))
    return runs.join(first, "key").filter("doc_id > first").select("doc_id", F.explode("places").alias("pos"))


def recurring_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = 3,
                    long_tokens: int = 8, min_constant: float = 0.7, min_masked: float = 0.5,
                    min_docs: int = 2, min_docs_short: int = 10) -> DataFrame:
    """``(doc_id, lines)``: for every document with lines to drop, their
    places (from 0, lines cut at ``\\n``) in ascending order.

    Null texts, empty texts and blank lines have nothing to drop.  Rows with a
    null id are neither counted nor dropped from.  Repeated rows (equal id and
    text) are one document.  Other columns are not read.
    """
    src = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    lines = materialize(_parsed(src, depth, long_tokens), "lines")
    general = materialize(_generalised(lines, long_tokens, min_constant), "templates")
    own = F.when(F.col("n") - F.col("n_var") >= min_masked * F.col("n"), F.xxhash64("n", "form")).otherwise(F.xxhash64(F.lit(-1), "raw"))
    keyed = lines.join(general, ["leaf", "form"], "left").select(
        "doc_id", "pos", F.coalesce("template", own).alias("template"), "words")
    keyed = materialize(keyed, "keyed")
    seen = keyed.groupBy("template", "doc_id").agg((F.max("words") >= long_tokens).alias("long"))
    templates = (seen.groupBy("template").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first"), F.max("long").alias("long"))
                     .filter(F.col("docs") >= min(min_docs, min_docs_short))
                     .select("template", "first", (F.col("docs") >= F.when(F.col("long"), min_docs).otherwise(min_docs_short)).alias("alone")))
    templates = materialize(templates, "recurring")
    hit = keyed.join(templates.filter("alone"), "template").filter("doc_id > first").select("doc_id", "pos")
    hit = hit.unionByName(_recurring_runs(keyed, templates, long_tokens, min_docs))
    return materialize(hit.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("lines")), "dropped")


def drop_lines(docs: DataFrame, hits: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines named by ``hits`` (``recurring_lines``) taken
    out of ``text``; columns and other rows stay as they are.  A document all
    of whose lines go keeps an empty text."""
    h = broadcast_if_small(hits.select(F.col("doc_id").alias("_hit_id"), F.col("lines").alias("_hit_lines")), SMALL_TABLE)
    # a column of its own: inside the function of `transform` the text would be cut again for every line
    parts = F.when(F.col("_hit_lines").isNotNull(), F.split(F.col(text), "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_hit_parts") - 1), F.col("_hit_lines"))
    left = F.array_join(F.transform(kept, lambda i: F.get("_hit_parts", i)), "\n")
    joined = docs.join(h, F.col(doc_id) == F.col("_hit_id"), "left").withColumn("_hit_parts", parts)
    return joined.withColumn(text, F.when(F.col("_hit_lines").isNull(), F.col(text)).otherwise(left)).drop("_hit_id", "_hit_lines", "_hit_parts")
