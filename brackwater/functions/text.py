"""File names, ids, paths and dates."""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

SLUGS = ("sentinel-2", "landsat-5", "landsat-7")
# Names that stand for a mission in paths of the training data.
ALIASES = {
    "sentinel-2": ("sentinel-2", "sentinel2", "s2"),
    "landsat-5": ("landsat-5", "landsat5", "lt05"),
    "landsat-7": ("landsat-7", "landsat7", "le07"),
}


def file_stem(path: Column) -> Column:
    """The file name without its folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def scene_id_from_path(path: Column) -> Column:
    """Scene id of '<mission>_<scene>_multiband.tif'; null without a known mission in front."""
    stem = F.regexp_replace(file_stem(path), r"(?i)_multiband$", "")
    got = F.regexp_extract(stem, r"(?i)^(?:sentinel-2|landsat-5|landsat-7)_(.+)$", 1)
    return F.when(got != "", got)


def mission_from_path(path: Column) -> Column:
    """First mission whose slug is in the file's name or its folder's, in the order of the registry; else null."""
    tail = F.lower(F.regexp_extract(path, r"((?:[^/]*/)?[^/]*)$", 1))
    return reduce(lambda out, slug: F.when(tail.contains(slug), slug).otherwise(out), reversed(SLUGS), F.lit(None).cast("string"))


def mission_from_alias(path: Column) -> Column:
    """Mission by alias: first in the folder, then in the file's stem, else the stem's first token (S3)."""
    parent = F.lower(F.regexp_extract(path, r"([^/]*)/[^/]*$", 1))
    stem = F.lower(file_stem(path))
    out = F.split_part(stem, F.lit("_"), F.lit(1))
    for text in (stem, parent):
        for slug in reversed(SLUGS):
            found = reduce(lambda a, b: a | b, [text.contains(a) for a in ALIASES[slug]])
            out = F.when(found, slug).otherwise(out)
    return out


def dataset_id(slug: Column) -> Column:
    """Satellite id of the training data; null for an unknown mission."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in (("landsat-5", 0), ("landsat-7", 1), ("sentinel-2", 2)) for x in kv]), slug)


def date_from_name(path: Column) -> Column:
    """Acquisition date in a mosaic's name: the second token's first eight digits for Sentinel, the fourth token for Landsat."""
    stem = F.regexp_replace(file_stem(path), r"(?i)_multiband$", "")
    sentinel = F.regexp_extract(stem, r"(\d{8})T\d{6}", 1)
    landsat = F.split_part(stem, F.lit("_"), F.lit(4))
    digits = F.when(F.lower(stem).startswith("sentinel"), sentinel).otherwise(landsat)
    return F.when(digits.rlike(r"^\d{8}$"), F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))


def strip_mission_prefix(stem: Column) -> Column:
    """Without a leading mission and underscore."""
    return F.regexp_replace(stem, r"(?i)^(?:sentinel-2|landsat-5|landsat-7|landsat-8)_", "")


def first_date(stem: Column) -> Column:
    """Date of the first run of eight digits, if year 1900-2100 and a real day; else null."""
    digits = F.regexp_extract(stem, r"(\d{8})", 1)
    day = F.when(digits != "", F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date"))
    return F.when(F.year(day).between(1900, 2100), day)


def cast_id(stem: Column, index: Column) -> Column:
    """'<stem>_<index with six digits>' (S8)."""
    return F.concat(stem, F.lit("_"), F.lpad(index.cast("string"), 6, "0"))


def raw_blob(scene_id: Column, sensor: Column, name: Column, prefix: str = "imagery/raw") -> Column:
    """Where a raw file lies (S9, SNK16)."""
    return F.concat_ws("/", F.lit(prefix), scene_id, sensor, name)


def processed_blob(scene_id: Column, task: Column, name: Column, prefix: str = "imagery/processed") -> Column:
    """Where a product lies (S9, SNK16)."""
    return F.concat_ws("/", F.lit(prefix), scene_id, task, name)


def blob_name(uri: Column, bucket: str) -> Column:
    """Path within a bucket of a gs:// URI; null for another bucket."""
    head = f"gs://{bucket}/"
    return F.when(uri.startswith(head), F.substring(uri, len(head) + 1, 1 << 30))


def comma_list(text: Column) -> Column:
    """Trimmed items of a comma-separated list, empty ones dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_box(text: Column) -> Column:
    """array<double> of exactly four numbers 'a,b,c,d', else null."""
    numbers = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when((F.size(numbers) == 4) & F.forall(numbers, lambda x: x.isNotNull()), numbers)


def canonical_json(parameters: dict | None) -> str:
    """JSON with sorted keys."""
    return json.dumps(parameters or {}, sort_keys=True)


def product_id(scene_id: str, task: str, parameters: dict | None = None) -> str:
    """Id of a run: the same for the same scene, task and parameters, whatever the order of keys."""
    return hashlib.md5(f"{scene_id}:{task}:{canonical_json(parameters)}".encode(), usedforsecurity=False).hexdigest()


def product_id_column(scene_id: Column, task: Column, parameters: Column) -> Column:
    """product_id() with the parameters as canonical JSON text."""
    return F.md5(F.concat_ws(":", scene_id, task, parameters))


def json_of_map(parameters: Column) -> Column:
    """Canonical JSON of a map<string,string>: keys sorted, ', ' and ': ' between."""
    entries = F.array_sort(F.map_entries(parameters))
    quoted = F.transform(entries, lambda e: F.concat(F.lit('"'), e["key"], F.lit('": "'), e["value"], F.lit('"')))
    return F.concat(F.lit("{"), F.concat_ws(", ", quoted), F.lit("}"))


def _holds(held: Column, asked: object) -> Column:
    """Whether a variant holds a JSON value: objects all its keys, lists for each of its values one that holds it, anything else an equal value."""
    kind = F.schema_of_variant(held)
    if isinstance(asked, dict):
        inside = F.when(kind.startswith("OBJECT"), held)
        return reduce(and_, [_holds(F.try_variant_get(inside, _path(key), "variant"), value) for key, value in asked.items()], kind.startswith("OBJECT"))
    if isinstance(asked, (list, tuple)):
        values = F.when(kind.startswith("ARRAY"), held).cast("array<variant>")
        return reduce(and_, [_any_holds(values, value) for value in asked], kind.startswith("ARRAY"))
    if asked is None:
        return kind == "VOID"
    if isinstance(asked, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(held, "$", "boolean") == asked)
    if isinstance(asked, (int, float)):
        return kind.rlike("^(BIGINT|DECIMAL|DOUBLE)") & (F.try_variant_get(held, "$", "double") == float(asked))
    return (kind == "STRING") & (F.try_variant_get(held, "$", "string") == str(asked))


def _any_holds(values: Column, asked: object) -> Column:
    return F.exists(values, lambda x: F.coalesce(_holds(x, asked), F.lit(False)))


def _path(key: object) -> str:
    """A variant's path to a key of any characters but both kinds of quotes."""
    quote = "'" if '"' in str(key) else '"'
    return f"$[{quote}{key}{quote}]"


def contains_json(held: Column, asked: dict) -> Column:
    """Whether JSON text holds the asked value as a part (R4): keys with dots, lists in any order, nulls as values. {} fits any object; text that is no JSON holds nothing."""
    return F.coalesce(_holds(F.try_parse_json(held), asked), F.lit(False))


def payload(data: Column, schema: str) -> Column:
    """A struct from base64 JSON."""
    return F.from_json(F.unbase64(data).cast("string"), schema)


def date_window(day: Column, before: int, after: int) -> tuple[Column, Column]:
    """First and last day of a window."""
    return F.date_sub(day, before), F.date_add(day, after)


def days_between(start: Column, end: Column, step: int) -> Column:
    """array<date> from start to end, both included, in steps of days."""
    return F.when(start <= end, F.sequence(start, end, F.make_dt_interval(days=F.lit(step)))).otherwise(F.array().cast("array<date>"))


def date_of_millis(millis: Column) -> Column:
    """UTC date of epoch milliseconds."""
    return F.timestamp_millis(millis).cast("date")


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """'YYYY-MM-DD' text, null for a year of 0 or less; month and day as they are (T4)."""
    return F.when(year > 0, F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")))


def period(day: Column, granularity: str = "M") -> Column:
    """Month, year or day of a date as text (T5)."""
    return F.date_format(day, {"M": "yyyy-MM", "Y": "yyyy", "D": "yyyy-MM-dd"}[granularity])
