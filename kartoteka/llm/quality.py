"""Line-first quality rules (DataFrame functions only).

Each line of a text is judged by itself; failing lines are removed, and a document that loses more than
`max_lost` per cent of its characters is rejected. Base counts of the whole text are kept beside the verdict.

Defined cases: a null text counts as empty; a text without words fails the base rule and is rejected; very long texts
and lines are judged whole, a line over NOTICE_WORDS words never as a notice; a share that equals a limit passes; of
equal lines the first is no duplicate; repeated rows are judged one by one and give equal results; an empty table gives
an empty result. Columns of the input other than the id and the text are carried along by `clean`, whatever their
names, and never looked at; a null in any of them stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm.common import settled, words

# Phrases of notices and page furniture in the languages of the corpus, in lower case; those of the second list are ordinary prose as well.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies", "enable javascript",
    "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "cookies akzeptieren",
    "tous droits réservés", "mentions légales", "politique de confidentialité", "conditions d'utilisation", "accepter les cookies", "todos los derechos reservados",
    "aviso legal", "política de privacidad", "términos de uso", "aceptar cookies",
)
CALLS = ("click here", "sign up", "log in", "subscribe to", "share on", "hier klicken", "cliquez ici", "haga clic aquí")
#: A notice is a phrase of the first list, as whole words, or a copyright sign in a line of no more words than NOTICE_WORDS; one of the second list
#: in a line of no more than CALL_WORDS, of which it is a good part.
NOTICE_WORDS, CALL_WORDS = 20, 6
_PHRASE = r"(^|[^\p{L}\p{N}])(%s)([^\p{L}\p{N}]|$)"
_NOTICE = _PHRASE % "|".join(BOILERPLATE) + r"|©|copyright \(c\)"
_CALL = _PHRASE % "|".join(CALLS)
_EITHER = _PHRASE % "|".join(BOILERPLATE + CALLS) + r"|©|copyright \(c\)"
#: Symbols that prose does not need; the base count uses the same ones.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, REPEAT_SHARE = 10, 20
MAX_LOST = 50  # per cent of characters
#: Lines of fewer words without closing punctuation count as navigation.
NAVIGATION_WORDS = 3
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: What may close a line of prose.
CLOSING = ".!?:;,)\"'»”…"


def _count(text: Column) -> Column:
    """How many characters of text are SYMBOLS."""
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))


def has_notice(text: Column) -> Column:
    return F.rlike(F.lower(text), F.lit(_EITHER))


def is_notice(line: Column) -> Column:
    """Whether a line is a notice or a call to click, by its phrase and its length."""
    low, n = F.lower(line), F.size(words(line))
    return (F.rlike(low, F.lit(_NOTICE)) & (n <= NOTICE_WORDS)) | (F.rlike(low, F.lit(_CALL)) & (n <= CALL_WORDS))


def line_fails(line: Column) -> Column:
    """Punctuation and navigation rules for one line that has a word."""
    symbols = _count(line) * 10 > F.length(line)
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit(""))) >= 6
    closed = F.substring(F.rtrim(line, F.lit(SPACE_CHARS)), -1, 1).isin(list(CLOSING))
    navigation = ~closed & (F.size(words(line)) < NAVIGATION_WORDS)
    return symbols | shouts | navigation


def repeat_words(df: DataFrame, word_col: str, out: str) -> DataFrame:
    """Words inside 5-word windows that the text has twice or more, first ones included.

    Windows are compared by a 64-bit hash of their words' hashes, only within one text.
    """
    k = WINDOW
    df = df.withColumn("_h", F.transform(word_col, lambda w: F.xxhash64(w)))
    at = ", ".join(f"_h[i + {j}]" for j in range(k))
    df = df.withColumn("_w", F.expr(f"if(size(_h) < {k}, array(), transform(sequence(0, greatest(size(_h), {k}) - {k}), i -> xxhash64({at})))"))
    # Sorting is for the few texts that repeat a window at all.
    df = df.withColumn(
        "_s",
        F.expr("if(size(array_distinct(_w)) = size(_w), null, array_sort(transform(_w, (h, i) -> struct(h as h, i as i))))"),
    )
    again = "(n > 0 and _s[n - 1].h = x.h) or (n < size(_s) - 1 and _s[n + 1].h = x.h)"
    starts = f"array_sort(array_compact(transform(_s, (x, n) -> if({again}, x.i, null))))"
    spread = f"aggregate({starts}, struct(-1000 as at, 0L as n), (a, x) -> struct(x as at, a.n + least({k}, x - a.at) as n), a -> a.n)"
    return df.withColumn(out, F.expr(f"coalesce({spread}, 0L)")).drop("_h", "_w", "_s")


def judge(docs: DataFrame, text: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """Add counts, `base_failed`, `clean_text` (without failing lines), `n_lines_removed`, `kept`."""
    df = docs.withColumn("_t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn("_words", words(F.col("_t")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    df = df.withColumn("n_symbols", _count(F.col("_t")).cast("long"))
    df = repeat_words(df, "_words", "n_repeat_words").drop("_words")
    df = df.withColumn("_lines", F.split("_t", "\n"))
    df = df.withColumn("_full", F.filter("_lines", lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    df = df.withColumn("n_dup_lines", (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long"))
    # Lines are searched for notices only where the text has one. The test stands outside of the lambda, where it runs once.
    good = F.filter("_full", lambda x: ~line_fails(x))
    df = df.withColumn("_good", F.when(has_notice(F.col("_t")), F.filter(good, lambda x: ~is_notice(x))).otherwise(good))
    df = df.withColumn("clean_text", F.array_join("_good", "\n"))
    all_chars = F.length(F.array_join("_full", "\n"))
    df = df.withColumn("n_lines_removed", (F.size("_full") - F.size("_good")).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words")))
    df = df.withColumn("kept", ~F.col("base_failed") & (100 * (all_chars - F.length("clean_text")) <= max_lost * all_chars))
    return settled(df.drop("_t", "_lines", "_full", "_good"))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with failing lines taken out of their texts; other columns stay."""
    own = docs.select(F.col(text).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    kept = judge(own, "_text").filter("kept")
    cols = [F.col("clean_text").alias(c) if c == text else F.length("clean_text").cast("long").alias(c) if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return kept.select(*cols)


def report(docs: DataFrame) -> DataFrame:
    """The digest: one row per document, of `doc_id` and `text` alone."""
    return judge(docs.select("doc_id", F.col("text").alias("text"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLE_SQL = rf"""
with t as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (
  select r, doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from t),
win as (select r, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) as i from w where len(ws) >= {WINDOW}),
keyed as (select r, i, list_slice(ws, i, i + {WINDOW - 1}) as k from win),
rep as (select r, i from keyed qualify count(*) over (partition by r, k) > 1),
cov as (
  select r, sum(least({WINDOW}, i - before))::bigint as n_repeat_words
  from (select r, i, lag(i, 1, -1000) over (partition by r order by i) as before from rep) group by r),
j as (
  select w.*, list_filter(lines, lambda x: not (
      length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) * 10 > length(x)
      or length(x) - length(replace(x, '!!', '')) >= 6
      or (len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) < {NAVIGATION_WORDS}
          and not regexp_matches(x, '[.!?:;,)"''»”…][\x20\x09-\x0D]*$'))
      or (len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) <= {NOTICE_WORDS}
          and regexp_matches(lower(x), '{_NOTICE.replace("'", "''")}'))
      or (len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) <= {CALL_WORDS} and regexp_matches(lower(x), '{_CALL}')))) as good
  from w),
m as (
  select doc_id, len(ws)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    length(array_to_string(lines, chr(10))) as all_chars, length(array_to_string(good, chr(10))) as left_chars
  from j left join cov using (r)),
b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_SHARE} * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * (all_chars - left_chars) <= {MAX_LOST} * all_chars as kept
from b
"""
