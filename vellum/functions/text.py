"""Text features of a line and cleaners, as columns. Classes of characters are spelled so that engines agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.distance import edit_distance

# First characters that count as bullets, special starts, closing punctuation, keywords.
BULLETS = "·○◌●◦◆◇◈■□★☆✓▶+-❖➢➣•[#x2014;]§†*¶"
SPECIAL = "'\"\\<>/@#$%^&*~"
CLOSING = "()[]{};:,"
KEYWORDS = ("appendix", "reference", "chapter", "section", "subsection")
ROMAN = "^M{0,3}(CM|CD|D?C{0,3})?(XC|XL|L?X{0,3})?(IX|IV|V?I{0,3})?$"
BLANK, BLANKS = "[ \\t\\r\\n\\f\\x0B]", " \t\r\n\f\x0B"


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def stripped(t: Column) -> Column:
    """Without blanks at both ends; a pattern would be tried at each place of the text."""
    return F.btrim(t, F.lit(BLANKS))


def words(t: Column) -> Column:
    return F.array_remove(F.split(t, f"{BLANK}+"), "")


def longest_run(t: Column, c: str) -> Column:
    runs = F.regexp_extract_all(t, F.lit(f"({c}+)"), 1)
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def contains_char(chars: str, c: Column) -> Column:
    return (F.length(c) > 0) & (F.instr(F.lit(chars), c) > 0)


def text_features(t: Column) -> dict[str, Column]:
    """Features of a line's text, by name."""
    s = stripped(t)
    first, last = F.substring(t, 1, 1), F.substring(s, -1, 1)
    low = F.lower(t)
    alone = F.filter(words(t), lambda w: w.rlike(r"^\p{L}+$"))
    upper = F.filter(alone, lambda w: w.rlike(r"^\p{Lu}"))
    compound = (F.length(s) > 1) & s.rlike(r"\p{L}")
    after = F.substring(t, 2, 1 << 30)
    first_word = F.get(words(low), F.lit(0))
    return {
        "num_chars": F.length(s),
        "num_words": F.size(words(t)),
        "is_all_caps": flag(t.rlike(r"\p{Lu}") & ~t.rlike(r"[\p{Ll}\p{Lt}]")),
        "is_title_case": flag((t.rlike(r"\p{L}") & ~t.rlike(r"\p{L}\p{Lu}|(^|\P{L})\p{Ll}")) | (F.size(upper) * 2 > F.size(alone))),
        "num_of_dots": F.when(compound, F.lit(0)).otherwise(F.regexp_count(after, F.lit(r"\."))),
        "num_of_spaces": F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))),
        "max_contiguous_dots": longest_run(F.replace(t, F.lit(" "), F.lit("")), r"\."),
        "max_contiguous_spaces": longest_run(F.replace(t, F.lit("."), F.lit("")), " "),
        "first_char_isdigit": flag(t.rlike(r"^\p{Nd}")),
        "first_char_bullet": flag(contains_char(BULLETS, first)),
        "first_char_upper": flag(t.rlike(r"^\p{Lu}")),
        "first_word_compound": flag(compound),
        "starts_with_keyword": flag(low.rlike(f"^({'|'.join(KEYWORDS)})") | first_word.rlike("|".join(KEYWORDS))),
        "first_char_special": flag(contains_char(SPECIAL, first)),
        "last_char_upper": flag(s.rlike(r"\p{Lu}$")),
        "last_char_punctuation": flag(contains_char(CLOSING, last)),
        "last_word_digit": flag(s.rlike(r"\p{Nd}$")),
        "last_word_roman": flag(F.element_at(F.split(s, " "), -1).rlike(ROMAN)),
    }


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


#: The same in SQL, over a column named text.
_S = r"regexp_replace(text, '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g')"
_W = r"list_filter(regexp_split_to_array(text, '[ \t\r\n\f\x0B]+'), lambda w: w <> '')"
_ALONE = rf"list_filter({_W}, lambda w: regexp_matches(w, '^\p{{L}}+$'))"
FEATURES_SQL = rf"""
  length({_S})::INT AS num_chars, len({_W})::INT AS num_words,
  (regexp_matches(text, '\p{{Lu}}') AND NOT regexp_matches(text, '[\p{{Ll}}\p{{Lt}}]'))::INT AS is_all_caps,
  ((regexp_matches(text, '\p{{L}}') AND NOT regexp_matches(text, '\p{{L}}\p{{Lu}}|(^|\P{{L}})\p{{Ll}}'))
    OR len(list_filter({_ALONE}, lambda w: regexp_matches(w, '^\p{{Lu}}'))) * 2 > len({_ALONE}))::INT AS is_title_case,
  CASE WHEN length({_S}) > 1 AND regexp_matches({_S}, '\p{{L}}') THEN 0 ELSE len(regexp_extract_all(substr(text, 2), '\.')) END::INT AS num_of_dots,
  len(regexp_extract_all({_S}, ' '))::INT AS num_of_spaces,
  coalesce(list_max(list_transform(regexp_extract_all(replace(text, ' ', ''), '\.+'), lambda r: length(r))), 0)::INT AS max_contiguous_dots,
  coalesce(list_max(list_transform(regexp_extract_all(replace(text, '.', ''), ' +'), lambda r: length(r))), 0)::INT AS max_contiguous_spaces,
  regexp_matches(text, '^\p{{Nd}}')::INT AS first_char_isdigit, (instr({_q(BULLETS)}, substr(text, 1, 1)) > 0)::INT AS first_char_bullet,
  regexp_matches(text, '^\p{{Lu}}')::INT AS first_char_upper, (length({_S}) > 1 AND regexp_matches({_S}, '\p{{L}}'))::INT AS first_word_compound,
  (regexp_matches(lower(text), '^({'|'.join(KEYWORDS)})') OR coalesce(regexp_matches(lower(({_W})[1]), '{'|'.join(KEYWORDS)}'), false))::INT AS starts_with_keyword,
  (instr({_q(SPECIAL)}, substr(text, 1, 1)) > 0)::INT AS first_char_special, regexp_matches({_S}, '\p{{Lu}}$')::INT AS last_char_upper,
  (length({_S}) > 0 AND instr({_q(CLOSING)}, right({_S}, 1)) > 0)::INT AS last_char_punctuation, regexp_matches({_S}, '\p{{Nd}}$')::INT AS last_word_digit,
  regexp_matches(string_split({_S}, ' ')[-1], '{ROMAN}')::INT AS last_word_roman
"""


# --- cleaners -------------------------------------------------------------------------------------------------------


def clean_text(t: Column) -> Column:
    """Entity marks out, ASCII letters, digits and white space stay, lower case, double spaces to one."""
    t = F.regexp_replace(t, r"\[#\w+;\]", "")
    t = stripped(F.lower(F.regexp_replace(t, r"[^a-zA-Z0-9 \t\r\n\f\x0B]", "")))
    return F.regexp_replace(t, " {2,}", " ")


CLEAN_SQL = r"""regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({0}, '\[#\w+;\]', '', 'g'), '[^a-zA-Z0-9 \t\r\n\f\x0B]', '', 'g')), '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g'), ' {{2,}}', ' ', 'g')"""


def clean_for_matching(t: Column) -> Column:
    """Lower case, whatever is no letter, mark, digit or underscore becomes one space."""
    return stripped(F.regexp_replace(F.lower(t), r"[^\p{L}\p{M}\p{N}_]+", " "))


MATCHING_SQL = r"""trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_]+', ' ', 'g'))"""


def key_text(t: Column) -> Column:
    """No white space, lower case; for finding changes."""
    return F.lower(F.regexp_replace(t, BLANK, ""))


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance of the texts without spaces around by the longer raw one; 1 for two empty ones. Texts of ASCII."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - edit_distance(F.trim(a), F.trim(b)) / longer)


def entity_guard(t: Column) -> Column:
    return F.regexp_replace(t, "&#([a-zA-Z0-9]+);?", "[#$1;]")


def strip_tags(t: Column) -> Column:
    return F.regexp_replace(t, "<[^>]*>?", "")


def dotted_leader(t: Column) -> Column:
    """Five dots, dashes or underscores in a row, spaces aside."""
    return F.replace(t, F.lit(" "), F.lit("")).rlike(r"\.{5,}|-{5,}|_{5,}")


def file_name(t: Column) -> Column:
    """Characters that file systems refuse become underscores, runs of them one."""
    return F.regexp_replace(F.regexp_replace(t, r'[\\/:*?"<>|\s]+', "_"), "_+", "_")


def revision(t: Column) -> Column:
    """Numbers of a text like rev.1.2."""
    return F.transform(F.split(F.regexp_extract(F.lower(t), r"rev\.?\s*([0-9]+(?:\.[0-9]+)*)", 1), r"\."), lambda x: x.try_cast("int"))


def chunks(t: Column, n: int) -> Column:
    """Parts of n words each; none for a text without words.

    The words are the one item of an array, and so the variable of a function: as an expression within the function of a
    part they would be split again for each part."""
    part = lambda w: lambda i: F.array_join(F.slice(w, i + 1, n), " ")
    parts = lambda w: F.when(F.size(w) > 0, F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(n)), part(w))).otherwise(F.array().cast("array<string>"))
    return F.get(F.transform(F.array(words(t)), parts), F.lit(0))
