"""String, array and name-key expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from access_lake.functions import fixed

ColumnLike = Column | str

# What Python's str.strip() drops: Unicode's white space and the ASCII
# separators 0x1c-0x1f.
_EDGE_SPACE = "".join(map(chr, [*range(9, 14), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_str(c: ColumnLike) -> Column:
    """Missing → '' and surrounding whitespace removed (STD-1). Texts that
    begin and end with a plain character, most of them, are left alone."""
    text = col(c).cast("string")

    def plain(at: Column) -> Column:  # texts compare by their bytes
        return (at >= "!") & (at < "\x7f")

    return F.coalesce(F.when(plain(text) & plain(F.substring(text, -1, 1)), text)
                       .otherwise(F.trim(text, F.lit(_EDGE_SPACE))), F.lit(""))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_of(columns: Sequence[ColumnLike], default: ColumnLike | None = None) -> Column:
    """First non-missing, non-empty of several alias columns (STD-12)."""
    parts = [blank_to_null(col(c).cast("string")) for c in columns]
    if default is not None:
        parts.append(col(default) if not isinstance(default, str) else F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def title_case(c: ColumnLike) -> Column:
    """Capitalise every letter run, also after apostrophes, hyphens and
    digits, like Python's ``str.title`` (STD-14). Spark's ``initcap`` only
    capitalises after whitespace."""
    runs = F.regexp_extract_all(col(c), F.lit(r"(\p{L}+|\P{L}+)"), 1)

    def cap(r: Column) -> Column:
        first = F.substring(r, 1, 1)
        # title-case mapping of the sharp s is 'Ss' (upper-case would be 'SS')
        head = F.when(first == "\u00df", F.lit("Ss")).otherwise(F.upper(first))
        return F.concat(head, F.lower(F.substring(r, 2, 1 << 30)))

    return F.array_join(F.transform(runs, cap), "")


def classify(c: ColumnLike, rules: Iterable[tuple[str, str]] = fixed.FACILITY_TYPE_RULES,
             default: str = fixed.FACILITY_TYPE_DEFAULT) -> Column:
    """First matching substring rule wins on the lower-cased text (SCL-2)."""
    low = F.lower(col(c).cast("string"))
    out = None
    for needle, label in rules:
        cond = low.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    conds = [text.contains(k) for k in keywords]
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def joined_lower(array_col: ColumnLike) -> Column:
    """Array elements joined with one space, lower-cased (the matching text
    of the service flags; NULL elements are skipped)."""
    return F.lower(F.array_join(col(array_col), " "))


def keyword_flags(array_col: ColumnLike,
                  flags: dict[str, list[str]] = fixed.SERVICE_KEYWORDS) -> list[Column]:
    """One boolean column per flag: any keyword occurs in the joined text
    (STD-7). The join makes boundary-sensitive keywords such as ``"art "``
    depend on the element that follows."""
    text = joined_lower(array_col)
    return [F.coalesce(contains_any(text, kws), F.lit(False)).alias(name)
            for name, kws in flags.items()]


def any_contains(array_col: ColumnLike, keywords: Iterable[str]) -> Column:
    """Any element contains any keyword, case-insensitive (STD-9). NULL
    elements yield NULL inside ``exists``, so the result is coalesced."""
    kws = list(keywords)
    return F.coalesce(
        F.exists(F.coalesce(col(array_col), F.array().cast("array<string>")),
                 lambda x: contains_any(F.lower(x), kws)),
        F.lit(False))


def flatten_pipe(array_col: ColumnLike) -> Column:
    """Array → ``a|b|c`` (STD-8); a missing array gives ''."""
    return F.coalesce(F.array_join(col(array_col), "|"), F.lit(""))


def as_array(text_col: ColumnLike) -> Column:
    """A field read as text that holds either a JSON array or a single
    string → ``array<string>``; missing → empty array (STD-6). A text that
    begins like an array but is none is a single string. Arrays of plain
    strings without blanks between them, the usual form, are cut at the
    quotes; any other goes through the JSON parser."""
    c = col(text_col)
    empty = F.array().cast("array<string>")
    cut = F.replace(c, F.lit('","'), F.lit("\x01"))  # a control character is not allowed inside a JSON string
    plain = cut.rlike(r'^\["[^"\\\x00\x02-\x1f]*"\]\z') & ~c.contains("\x01")
    return (F.when(c.isNull() | (c == "") | (c == "[]"), empty)
            .when(c.startswith('["') & plain, F.split(cut.substr(F.lit(3), F.length(cut) - 4), "\x01", -1))
            .when(F.ltrim(c).startswith("["),
                  F.coalesce(F.from_json(c, "array<string>", {"mode": "PERMISSIVE"}), F.array(c)))
            .otherwise(F.array(c)))


def area_key(c: ColumnLike) -> Column:
    """Join key of the marts: lower-case, '-' → ' ', apostrophes removed
    (JON-1)."""
    return F.translate(F.lower(col(c)), "-'", " ")


def area_key_geo(c: ColumnLike, aliases: Iterable[tuple[str, str]] = fixed.GEO_NAME_ALIASES) -> Column:
    """Boundary-side key: alias map first, else lower-case, a dash with any
    surrounding spaces → one space, apostrophes removed (JON-4)."""
    low = F.lower(col(c))
    fallback = F.regexp_replace(F.regexp_replace(low, r"\s*-\s*", " "), "'", "")
    return map_alias(low, aliases, fallback)


def map_alias(c: ColumnLike, aliases: Iterable[tuple[str, str]],
              fallback: ColumnLike | None = None) -> Column:
    """Simple CASE alias map (SCL-4); unmatched values fall back."""
    src = col(c)
    out = None
    for a, b in aliases:
        out = F.when(src == a, F.lit(b)) if out is None else out.when(src == a, F.lit(b))
    fb = src if fallback is None else col(fallback)
    return out.otherwise(fb) if out is not None else fb


def eq_ci(c: ColumnLike, value: str) -> Column:
    """Case-insensitive equality (FLT-1, FLT-5)."""
    return F.lower(col(c)) == value.lower()


def normalise_header(name: str) -> str:
    """Header normalisation: trim, lower, space and '-' → '_' (STD-11)."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def date_parts(ts: ColumnLike) -> list[Column]:
    """Zero-padded ``year``, ``month``, ``day`` text of a timestamp, the
    landing partition values (SCL-14)."""
    t = col(ts)
    return [F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day")]


def feature_json(geometry: ColumnLike, props: Column) -> Column:
    """A GeoJSON Feature around raw geometry text (SCL-5). ``props`` is a
    struct; ``to_json`` escapes quotes in names and keeps NULL values."""
    return F.concat(F.lit('{"type":"Feature","geometry":'), col(geometry),
                    F.lit(',"properties":'), F.to_json(props, {"ignoreNullFields": "false"}),
                    F.lit("}"))
