"""Column functions: keys, lenient casts, list cells, ratios and bands."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that a lenient boolean reads (fixed values).
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")
#: Spellings of a missing identifier (fixed values).
MISSING_WORDS = ("", "none", "null", "nan")


def surrogate_key(*columns: Column, separator: str = "|") -> Column:
    """md5 of the columns as text, joined by a separator; null counts as empty, so the separators always stay."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.lit(separator)] * bool(i) + [F.coalesce(c.cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null where the whole is zero or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def rate(condition: Column) -> Column:
    """Aggregate: share of rows where the condition holds; null counts as not held."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def strategic_score(cast: Column, received: Column, betrayals: Column) -> Column:
    """(cast - received + betrayals) / cast, 0 where none was cast."""
    return F.when(cast == 0, 0.0).otherwise((cast - received + betrayals) / cast)


def season_weight(rank: Column) -> Column:
    """1 and a hundredth for each rank."""
    return 1 + rank / 100.0


def bucket(value: Column, ladder: Iterable[tuple[str, str]], default: str | None = None, ignore_case: bool = True) -> Column:
    """Label of the first LIKE pattern that matches; the default where none does (null included)."""
    out = None
    for pattern, label in ladder:
        hit = value.ilike(pattern) if ignore_case else value.like(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)


def band(value: Column, ladder: Iterable[tuple[float, str]], top: str) -> Column:
    """Label of the first upper limit above the value; ``top`` beyond the last, and for null."""
    out = None
    for limit, label in ladder:
        out = F.when(value < limit, label) if out is None else out.when(value < limit, label)
    return out.otherwise(top)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (null included)."""
    return F.when(condition, 1).otherwise(0)


def clean_id(value: Column) -> Column:
    """Trimmed text; null for blanks and the usual words for nothing."""
    trimmed = F.trim(value.cast("string"))
    return F.when(~F.lower(trimmed).isin(*MISSING_WORDS), trimmed)


def clean_name(value: Column) -> Column:
    """Trimmed text; null for blanks."""
    return F.nullif(F.trim(value), F.lit(""))


def lenient_boolean(value: Column) -> Column:
    """True or false for the known spellings and for numbers equal to 1 or 0; else null."""
    word = F.lower(F.trim(value.cast("string")))
    number = word.try_cast("double")
    return F.when(word.isin(*TRUE_WORDS) | (number == 1), True).when(word.isin(*FALSE_WORDS) | (number == 0), False)


def lenient_integer(value: Column, truncate: bool = False) -> Column:
    """Whole numbers in any decimal spelling. A fraction is null, or cut with ``truncate``."""
    number = F.trim(value.cast("string")).try_cast("double")
    fits = number.between(-2147483648.0, 2147483647.0) & (F.lit(truncate) | (number == F.floor(number)))
    return F.when(fits, number.cast("long").cast("int"))


def lenient_double(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("double")


def lenient_date(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("date")


def lenient_timestamp(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("timestamp")


def rounded_integer(value: Column) -> Column:
    """Numeric text rounded to a whole number; null for other text."""
    return F.round(F.trim(value.cast("string")).try_cast("double")).cast("int")


def split_cell(value: Column, separator: str = ",") -> Column:
    """Members of a cell: split, trimmed, blanks dropped, in order; null for a null cell."""
    return F.filter(F.transform(F.split(value, separator), lambda x: F.trim(x)), lambda x: x != "")


def join_cell(items: Column, separator: str = ", ") -> Column:
    """Distinct members in order of first occurrence as text; null if there are none."""
    return F.nullif(F.array_join(F.array_distinct(items), separator), F.lit(""))


def align_cells(items: Column, n: Column) -> Column:
    """``n`` members: cut, or padded with the last one (null for an empty list)."""
    last = F.try_element_at(items, F.lit(-1))
    return F.slice(F.concat(items, F.array_repeat(last, F.greatest(n - F.size(items), F.lit(0)))), F.lit(1), n)


def others(items: Column, own: Column) -> Column:
    """The members other than ``own``."""
    return F.filter(items, lambda x: ~x.eqNullSafe(own))


def first_token(value: Column) -> Column:
    return F.nullif(F.get(F.split(F.trim(value), r"\s+"), F.lit(0)), F.lit(""))


def success_label(value: Column) -> Column:
    """Outcome spellings as yes, no or not needed; other text in lower case, blanks null."""
    word = F.lower(F.trim(value))
    return F.when(word == "", None).when(word.isin("yes", "y", "true"), "yes").when(word.isin("no", "n", "false"), "no").when(word.like("%not needed%"), "not needed").otherwise(word)


def changed(a: Column, b: Column) -> Column:
    """Whether two values differ, null being equal to null."""
    return ~a.eqNullSafe(b)


def correlation(a: Column, b: Column) -> Column:
    """Sample correlation as an aggregate over rows where both are known; null where either is constant."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.covar_samp(x, y) / F.nullif(F.stddev_samp(x) * F.stddev_samp(y), F.lit(0.0))


def normalised_name(value: Column) -> Column:
    """Lower-case letters a-z and digits alone, accents taken off."""
    @F.pandas_udf("string")
    def run(names: pd.Series) -> pd.Series:
        plain = names.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")
        return plain.str.lower().str.replace(r"[^a-z0-9]", "", regex=True)

    return run(value)


def letters_in_common(a: Column, b: Column) -> Column:
    """How many letters two names have in common, each as often as both have it."""
    letters = lambda x: F.filter(F.split(x, ""), lambda c: c != "")
    often = lambda x, c: F.length(x) - F.length(F.replace(x, c, F.lit("")))
    return F.aggregate(F.array_distinct(letters(a)), F.lit(0), lambda n, c: n + F.least(often(a, c), often(b, c)))


def longest_block(a: str, b: str) -> tuple[int, int, int]:
    """Start in ``a``, start in ``b`` and length of the longest common stretch; of equals the first in ``a``, then in ``b``."""
    best, before = (0, 0, 0), [0] * (len(b) + 1)
    for i, x in enumerate(a):
        now = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                now[j + 1] = n = before[j] + 1
                start = (i - n + 1, j - n + 1)
                if n > best[2] or n == best[2] and start < best[:2]:
                    best = (*start, n)
        before = now
    return best


def matching_letters(a: str, b: str) -> int:
    """Letters in the longest common stretch and, in turn, in those on either side of it."""
    i, j, n = longest_block(a, b)
    return n and n + matching_letters(a[:i], b[:j]) + matching_letters(a[i + n :], b[j + n :])


def name_similarity(a: Column, b: Column) -> Column:
    """Twice the matching letters of two names over all their letters (0 to 1); of two empty names 1."""
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        found = [None if p is None or q is None else 2 * matching_letters(q, p) / (len(p) + len(q)) if p or q else 1.0 for p, q in zip(x, y)]
        return pd.Series(found, dtype="float64")

    return run(a, b)


def letters_gone(value: Column, n: int) -> Column:
    """The distinct texts that are left of a text when ``n`` of its letters go."""
    without = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    out = F.array(value)
    for _ in range(n):
        out = F.array_distinct(F.flatten(F.transform(F.filter(out, lambda x: F.length(x) > 0), without)))
    return out


def iso_timestamp(value: Column) -> Column:
    """A timestamp in ISO form, with Z or an offset, in the session's time zone; null for other text."""
    return F.trim(value).try_cast("timestamp")
