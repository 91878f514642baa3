"""Text columns: cleaning, tokens, counts. Every function maps Column to Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeseek.functions import kernels

# A token is a maximal run of letters, digits and underscores.
LETTER = r"[\p{L}\p{N}_]"
WORD = f"{LETTER}+"

# The characters Unicode calls white space, plus the four separators
# U+001C to U+001F, which text splitting also treats as white space.
SPACE_SET = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACES = f"[{SPACE_SET}]+"
NOT_SPACES = f"[^{SPACE_SET}]+"
# Runs that are not already a single blank; leaving those alone saves most replacements.
UNEVEN_SPACES = rf"[{SPACE_SET}&&[^ ]][{SPACE_SET}]*| [{SPACE_SET}]+"

# Typographic quotes and dashes, and what they become.
CURLY = "“”‘’–—"
STRAIGHT = "\"\"''--"

# Punctuation that cleaning deletes.
DELETED = "()/*\\><+=~^|#_%'\"" + ",.!?;:"

# Ranges whose characters NFKC leaves as they are and that never combine
# with a neighbour: ASCII, Latin letters with accents, Cyrillic, kana, Han.
NFKC_STABLE = (
    r"\x00-\x7f\x{a1}-\x{a7}\x{a9}\x{ab}-\x{ae}\x{b0}\x{b1}\x{b6}\x{b7}\x{bb}\x{bf}-\x{131}"
    r"\x{134}-\x{13e}\x{141}-\x{148}\x{14a}-\x{17e}\x{400}-\x{481}"
    r"\x{2018}\x{2019}\x{201c}\x{201d}\x{2013}\x{2014}"
    r"\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fff}"
)


_nfkc_batch = F.pandas_udf(kernels.nfkc, T.StringType())


def _unstable(text: Column) -> Column:
    """True where normalisation could change something; ASCII is told by its length."""
    return (F.octet_length(text) != F.char_length(text)) & text.rlike(f"[^{NFKC_STABLE}]")


def nfkc(text: Column) -> Column:
    """Compatibility normalisation.

    Spark has no built-in for it, so texts go to Python in Arrow batches, and only the
    texts that hold a character outside the stable ranges are sent.
    """
    return F.coalesce(_nfkc_batch(F.when(_unstable(text), text)), text)


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends.

    A run inside the text is tried once, at its begin, so long runs cost no more than short ones.
    """
    return F.regexp_replace(text, rf"\A[{SPACE_SET}]++|(?<![{SPACE_SET}])[{SPACE_SET}]++\z", "")


def is_blank(text: Column) -> Column:
    """True for null, empty and white space only."""
    return F.coalesce(~text.rlike(f"[^{SPACE_SET}]"), F.lit(True))


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, UNEVEN_SPACES, " "))


def clean_text(text: Column, normalise: bool = True) -> Column:
    """Straighten quotes and dashes, normalise, drop punctuation, lower-case, squeeze.

    Straightened quotes are dropped and straightened dashes become blanks, so where
    nothing needs normalising one replacement of characters does all of it.
    """
    out = F.translate(text, "–—-" + DELETED + "“”‘’", "   ")
    if normalise:
        straight = F.translate(text, CURLY, STRAIGHT)
        changed = _nfkc_batch(F.when(_unstable(text), straight))
        out = F.coalesce(F.translate(changed, "-" + DELETED, " "), out)
    out = F.replace(out, F.lit("&"), F.lit("and"))
    out = F.replace(out, F.lit("@"), F.lit("at"))
    return squeeze(F.lower(out))


def clean_text_without(text: Column, stop_words: Sequence[str]) -> Column:
    """Cleaning without normalisation, then without the given words."""
    words = F.split(clean_text(text, normalise=False), " ")
    kept = F.filter(words, lambda w: ~w.isin(list(stop_words)) & (w != ""))
    return F.array_join(kept, " ")


def tokens(text: Column) -> Column:
    """Lower-case word tokens in order; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def has_token(text: Column, words: Sequence[str]) -> Column:
    """Whether one of ``words`` is among the tokens; a text is read up to the first of them."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    found = F.lit(False)
    for word in words:
        letters = "".join(rf"\x{{{ord(c):x}}}" for c in word)
        bounded = rf"(?<!{LETTER}){letters}(?!{LETTER})"
        # What is no run of letters is never a token.
        found = found | (F.lit(word).rlike(rf"\A{WORD}\z") & lowered.rlike(bounded))
    return found


def with_term_bag(df: DataFrame, text: Column, keep: Sequence[str]) -> DataFrame:
    """One row per document: ``keep``, its length ``dl`` and its ``bag`` of (term, tf).

    A document is one row, so its terms are counted inside the row: sort the tokens,
    find where each run starts, subtract neighbouring starts. No shuffle is needed.
    """
    keep = list(keep)
    ordered = df.select(*keep, F.sort_array(tokens(text)).alias("_sorted"))
    starts = ordered.select(
        *keep,
        "_sorted",
        F.size("_sorted").cast("long").alias("dl"),
        F.array_compact(
            F.transform(
                "_sorted",
                lambda t, i: F.when((i == 0) | (t != F.get(F.col("_sorted"), i - 1)), i),
            )
        ).alias("_starts"),
    )
    bag = F.transform(
        "_starts",
        lambda start, n: F.struct(
            F.get(F.col("_sorted"), start).alias("term"),
            (F.coalesce(F.get(F.col("_starts"), n + 1).cast("long"), F.col("dl")) - start).alias("tf"),
        ),
    )
    return starts.select(*keep, "dl", bag.alias("bag"))


def word_count(text: Column) -> Column:
    """Number of pieces between white space; null text counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACES))


def search_text(title: Column, description: Column, content: Column) -> Column:
    """Title, description and body as one text; missing parts are empty."""
    return F.concat_ws(
        " ",
        F.coalesce(title, F.lit("")),
        F.coalesce(description, F.lit("")),
        F.coalesce(content, F.lit("")),
    )


def search_text_short(title: Column, content: Column) -> Column:
    """Title and body only, as the command-line ranking uses."""
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(content, F.lit("")))


def encoder_text(content: Column) -> Column:
    return F.coalesce(content, F.lit(""))


def record_key(record_id: Column, width: int = 6) -> Column:
    """Decimal id padded with zeros; longer ids stay whole."""
    digits = record_id.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def preview(content: Column, size: int = 300) -> Column:
    """First ``size`` characters, marked when something was left out."""
    text = F.coalesce(content, F.lit(""))
    return F.concat(
        F.substring(text, 1, size), F.when(F.length(text) > size, "...").otherwise("")
    )


def snippet(content: Column, size: int = 300) -> Column:
    """One-line form of the preview, always marked."""
    text = F.substring(F.coalesce(content, F.lit("")), 1, size)
    return F.concat(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("..."))


def compose_query(first: Column, second: Column, third: Column) -> Column:
    """Three form fields as one query text."""
    return strip(F.concat(first, F.lit(". "), second, F.lit(". "), third))
