"""Small functions on values, names of files and dates, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import DAYS
from .text import strip_accents

# Words that mean that there is no value.
NO_VALUE = ("", "null", "none", "n/a")
# Countries whose records are Spanish (others' are Portuguese), what a type of record is called, types by subject.
SPANISH = ("Colombia", "Cuba", "Mexico", "United States")
PHRASES = {"baptism": "baptismal register", "marriage": "marriage register", "burial": "burial register"}
SUBJECTS = {"Baptisms": "baptism", "Marriages": "marriage", "Burials": "burial"}
IMAGE_TYPES = r"(?i)\.(jpe?g|png|tiff?)$"


def folded(value: Column) -> Column:
    """Trimmed, lower case, without accents; booleans as true and false."""
    return F.trim(strip_accents(value.cast("string")))


def compared(value: Column) -> Column:
    """``folded``, with words that mean no value as null."""
    text = folded(value)
    return F.when(~text.isin(*NO_VALUE), text)


def compared_list(values: Column) -> Column:
    """The compared values of a list, sorted and joined by bars; null if none is left."""
    kept = F.array_sort(F.filter(F.transform(values, compared), lambda v: v.isNotNull()))
    return F.nullif(F.array_join(kept, "|"), F.lit(""))


def plain_value(value: Column) -> Column:
    """Trimmed lower case; blank as null."""
    return F.nullif(F.lower(F.trim(value.cast("string"))), F.lit(""))


def without_space(text: Column) -> Column:
    """Lower case without any white space; null as empty."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def cell(value: Column) -> Column:
    """A value as a CSV cell: null as empty, booleans in lower case."""
    return F.coalesce(value.cast("string"), F.lit(""))


def shortened(text: Column, most: int) -> Column:
    """White space runs as one space, trimmed, at most ``most`` characters: a preview."""
    return F.left(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), F.lit(most))


def stem(image: Column) -> Column:
    """A file name without its image type."""
    return F.regexp_replace(F.coalesce(image, F.lit("")), IMAGE_TYPES, "")


def image_id(image: Column) -> Column:
    """What stands after the last hyphen of an image's name."""
    return F.substring_index(stem(image), "-", -1)


def entry_id(image: Column, n: Column) -> Column:
    """The image's id and a number of two digits."""
    return F.concat(image_id(image), F.lit("-"), F.lpad(n.cast("string"), F.greatest(F.lit(2), F.length(n.cast("string"))), F.lit("0")))


def entry_order(entry: Column, pages: Column) -> Column:
    """Sort key of an id like 0013-02: page, place, id; of other ids the first source page (9999 without one), 999, id."""
    part = lambda i: F.nullif(F.regexp_extract(entry, r"^([0-9]{4})-([0-9]{2,3})$", i), F.lit(""))
    return F.struct(F.coalesce(part(1), F.get(pages, F.lit(0)), F.lit("9999")).alias("page"), F.coalesce(part(2).try_cast("int"), F.lit(999)).alias("place"), entry.alias("id"))


def page_of(entry: Column) -> Column:
    """The page that a reference's id begins with; null without one."""
    return F.nullif(F.regexp_extract(entry, r"^([0-9]{3,4})-", 1), F.lit(""))


def pages_of(images: Column, entry: Column) -> Column:
    """Pages that a prediction's images and id name."""
    of_images = F.transform(images, lambda i: F.regexp_extract(i, r"-([0-9]{3,4})\.", 1))
    of_id = F.regexp_extract(entry, r"-([0-9]{3,4})-[0-9]+$", 1)
    return F.array_distinct(F.filter(F.concat(F.coalesce(of_images, F.array().cast("array<string>")), F.array(F.coalesce(of_id, F.lit("")))), lambda p: p != ""))


def own_id(custom_id: Column, prefix: str) -> Column:
    """An id without the prefix of an early run."""
    return F.when(custom_id.startswith(prefix), F.substr(custom_id, F.lit(len(prefix) + 1))).otherwise(custom_id)


def run_id(custom_id: Column, run: str) -> Column:
    return F.concat(F.lit(f"{run}-"), custom_id) if run else custom_id


def date_parts(date: Column) -> Column:
    """Numbers of an ISO date or of a range start/end, in order."""
    pieces = F.filter(F.split(date, "[-/]"), lambda p: p != "")
    return F.transform(pieces, lambda p: p.try_cast("int"))


def not_after(x: Column, y: Column) -> Column:
    """Whether one list of date parts is on or before another, by the parts they share."""
    both = F.zip_with(x, y, lambda a, b: F.coalesce(F.signum(a - b).cast("int"), F.lit(0)))
    first = F.get(F.filter(both, lambda d: d != 0), F.lit(0))
    return F.coalesce(first, F.lit(0)) <= 0


def completed_parts(parts: Column, mode: str = "m") -> Column:
    """A partial date's parts made full: its first day (s), last day (e) or both (m). February has 28 days."""
    y, m, d = (F.get(parts, F.lit(i)) for i in range(3))
    n = F.size(parts)
    last = F.get(F.array(*map(F.lit, DAYS)), F.coalesce(m, F.lit(12)) - 1)
    first = F.array(y, F.when(n == 1, 1).otherwise(m), F.lit(1))
    end = F.array(y, F.when(n == 1, 12).otherwise(m), F.when(n == 1, 31).otherwise(last))
    if mode == "s":
        return first
    if mode == "e":
        return end
    return F.when(n >= 3, F.array(y, m, d, y, m, d)).otherwise(F.concat(first, end))


def earliest_year(dates: Column) -> Column:
    """The least year of four digits that a date of the list begins with."""
    return F.array_min(F.transform(dates, lambda d: F.regexp_extract(d, r"^\s*([0-9]{4})", 1).try_cast("int")))


def cleaned_lines(text: Column, heal: bool = True) -> Column:
    """Stripped lines joined by spaces; with ``heal``, a line's last hyphen goes and the next line is glued on."""
    lines = F.filter(F.transform(F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    if heal:
        joined = F.aggregate(lines, F.lit(""), lambda a, x: F.when(a == "", x).when(a.endswith("-"), F.concat(F.left(a, F.length(a) - 1), x)).otherwise(F.concat(a, F.lit(" "), x)))
    else:
        joined = F.array_join(lines, " ")
    return F.trim(F.regexp_replace(joined, r"(?U)\s+", " "))


def language_of(country: Column) -> Column:
    return F.when(country.isin(*SPANISH), "Spanish").otherwise("Portuguese")


def record_phrase(kind: Column) -> Column:
    """What a type of record is called in an instruction."""
    return F.coalesce(F.create_map(*[F.lit(x) for pair in PHRASES.items() for x in pair])[kind], F.lit("sacramental record"))


def volume_type(subject: Column) -> Column:
    """The type of a volume from its subject: the first word found."""
    found = [F.when(subject.contains(word), kind) for word, kind in SUBJECTS.items()]
    return F.coalesce(*found)
