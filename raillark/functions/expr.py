"""Column functions of timetable and realtime work; built-in expressions only.

Texts follow one rule: the empty string means "none" inside tables.  Parsing
never raises: what cannot be read is null.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
DEGREE_M = 111_320.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _accents() -> tuple[str, str]:
    """Letters with a mark and their ASCII base letters, by Unicode decomposition."""
    pairs = [(chr(p), unicodedata.normalize("NFKD", chr(p))) for p in range(0xC0, 0x10000)]
    pairs = [(c, d[0]) for c, d in pairs if len(d) > 1 and d[0].isascii() and all(unicodedata.combining(x) for x in d[1:])]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters that fold to one other, those and marks that vanish (at the end of the first), and those that fold to several.

    Folding is compatibility decomposition and case folding less all marks.  Hangul
    syllables stay composed.
    """
    one, gone, many = [], [], []
    for p in (p for p in range(0x41, 0x10000) if not 0xD800 <= p < 0xE000 and not 0xAC00 <= p < 0xD7A4):
        c = chr(p)
        d = "".join(x for x in unicodedata.normalize("NFKD", c).casefold() if not unicodedata.combining(x))
        if d == c:
            continue
        if len(d) == 1:
            one.append((c, d))
        elif not d:
            gone.append(c)
        elif c.isalpha() and d.isalpha() and p < 0x2000 or 0xFB00 <= p < 0xFB07:
            many.append((c, d))
    return "".join(c for c, _ in one) + "".join(gone), "".join(d for _, d in one), many


_MARKED, _PLAIN = _accents()
_FROM, _TO, _SEVERAL = _folds()


def folded(c: Column | str) -> Column:
    """Text for comparison: no case, no marks, compatible forms alike, single blanks."""
    out = col(c)
    several = F.rlike(out, F.lit("[" + "".join(x for x, _ in _SEVERAL) + "]"))
    spelled = out
    for a, b in _SEVERAL:
        spelled = F.replace(spelled, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(F.translate(F.when(several, spelled).otherwise(out), _FROM, _TO), "\\s+", " "))


def search_name(c: Column | str) -> Column:
    """Lower case, German letters spelled out, trimmed."""
    out = F.lower(col(c))
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def unaccented(c: Column | str) -> Column:
    return F.translate(col(c), _MARKED, _PLAIN)


def slug(c: Column | str, default: str = "stop") -> Column:
    """ASCII letters and digits joined by single hyphens; ``default`` if nothing is left."""
    out = F.regexp_replace(unaccented(search_name(c)), "[^\\x00-\\x7F]", "")
    out = F.regexp_replace(F.regexp_replace(out, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def service_seconds(c: Column | str, strict: bool = True) -> Column:
    """Seconds since the service day began; hours may pass 24."""
    part = F.split(F.trim(col(c)), ":")
    h, m, s = (F.get(part, k).try_cast("int") for k in range(3))
    total = h * 3600 + m * 60 + s
    ok = F.size(part) == 3
    if strict:
        ok &= (h >= 0) & m.between(0, 59) & s.between(0, 59)
    return F.when(ok, total)


def prefix_id(c: Column | str, prefix: str, idempotent: bool = True) -> Column:
    """``prefix`` before a native id; an empty id stays empty, a prefixed one stays as it is."""
    value = F.trim(col(c))
    out = F.when(value == "", F.lit(""))
    if idempotent and prefix:
        out = out.when(value.startswith(prefix), value)
    return out.otherwise(F.concat(F.lit(prefix), value))


def native_id(c: Column | str, prefixes: list[str], strict: bool = False) -> Column:
    """The id less its longest matching prefix; ``strict`` gives '' where none matches."""
    value, out = col(c), None
    for p in sorted(prefixes, key=len, reverse=True):
        rest = F.substr(value, F.lit(len(p) + 1))
        out = F.when(value.startswith(p), rest) if out is None else out.when(value.startswith(p), rest)
    last = F.lit("") if strict else value
    return last if out is None else out.otherwise(last)


def filled(c: Column | str) -> Column:
    """Trimmed text, null if empty."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def line_label(short: Column | str, long: Column | str, route_id: Column | str) -> Column:
    return F.coalesce(filled(short), filled(long), col(route_id))


def line_names(short: Column | str, long: Column | str) -> Column:
    """Distinct non-empty names, the short one first; null if there is none."""
    out = F.array_distinct(F.filter(F.array(F.trim(col(short)), F.trim(col(long))), lambda x: x != ""))
    return F.when(F.size(out) > 0, out)


def destination(headsign: Column | str, terminal: Column | str, *rest: Column | str, default: str | None = None) -> Column:
    """First non-empty of headsign, terminal stop name and the rest."""
    parts = [filled(c) for c in (headsign, terminal, *rest)]
    return F.coalesce(*parts, F.lit(default)) if default is not None else F.coalesce(*parts)


def direction_key(route: Column | str, direction: Column | str, terminal: Column | str, name: Column | str) -> Column:
    """Key of one direction of a line, by its terminal stop or else by its folded destination."""
    base = F.concat(col(route), F.lit("|direction:"), F.trim(F.coalesce(col(direction), F.lit(""))))
    stop = filled(terminal)
    return F.when(stop.isNotNull(), F.concat(base, F.lit("|destination-stop:"), stop)).otherwise(F.concat(base, F.lit("|destination:"), folded(name)))


def mode_of_route_type(c: Column | str) -> Column:
    """Mode of a base or extended route type; null for others."""
    v = col(c).try_cast("int")
    out = F.when((v == 0) | v.between(900, 999), "tram").when((v == 1) | v.between(400, 499), "subway")
    return out.when((v == 2) | v.between(100, 199), "train").when((v == 3) | v.between(700, 799), "bus").when((v == 4) | v.between(1000, 1099), "ferry")


# Numeric product classes by mode.
PRODUCT_CLASSES = {"regionalTrain": [0, 1, 13, 15, 16], "subway": [2, 3], "tram": [4], "bus": [5, 6, 7, 8, 11], "ferry": [9]}


def mode_of_product_class(cls: Column | str, name: Column | str) -> Column:
    """Mode of a numeric product class, else by the line name's first letters."""
    v, label = col(cls).try_cast("int"), F.lower(F.coalesce(col(name), F.lit("")))
    out = F.when(F.lit(False), F.lit(""))
    for mode, classes in PRODUCT_CLASSES.items():
        out = out.when(v.isin(classes), mode)
    return out.when(label.startswith("s"), "suburbanTrain").when(label.rlike("^(re|rb|ic|ec)"), "regionalTrain").otherwise("unknown")


def location_type(c: Column | str) -> Column:
    """0 to 4; anything else counts as 0."""
    v = F.trim(col(c).cast("string")).try_cast("int")
    return F.when(v.between(0, 4), v).otherwise(0)


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def equirect_m(lat1, lon1, lat2, lon2) -> Column:
    """Distance in metres on a plane at the mean latitude."""
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    x, y = (d - b) * F.cos((a + c) / 2), c - a
    return F.sqrt(x * x + y * y) * EARTH_M


def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Direction of a short segment, 0 to 360, on the same plane."""
    a, b, c, d = (F.radians(col(x)) for x in (lat1, lon1, lat2, lon2))
    return bearing_norm(F.degrees(F.atan2((d - b) * F.cos((a + c) / 2), c - a)))


def bearing_diff(a, b) -> Column:
    """Smallest angle between two bearings."""
    d = F.abs(col(a) - col(b)) % 360
    return F.least(d, F.lit(360.0) - d)


def bearing_norm(c) -> Column:
    """Into 0 to 360; null if not finite."""
    v = col(c)
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), F.pmod(v, F.lit(360.0)))


def positive_or_null(c) -> Column:
    v = col(c)
    return F.when((v > 0) & ~F.isnan(v) & (v < float("inf")), v)


def radius_region(lat, lon, radius_m) -> Column:
    """Bounding box of a circle."""
    a, b, r = col(lat), col(lon), col(radius_m)
    dy = r / DEGREE_M
    dx = r / (F.greatest(F.cos(F.radians(a)), F.lit(0.2)) * DEGREE_M)
    return F.struct((b - dx).alias("min_lon"), (a - dy).alias("min_lat"), (b + dx).alias("max_lon"), (a + dy).alias("max_lat"))


def grid_cell(c, size: float) -> Column:
    return F.floor(col(c) / F.lit(size))


def iso_utc(c) -> Column:
    """Epoch seconds as ISO text; the session's zone does not matter."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(col(c)).cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def service_instant(date, seconds, tz) -> Column:
    """UTC wall time of a service date (yyyyMMdd) plus seconds of wall time in a zone."""
    day = F.to_date(col(date), "yyyyMMdd").cast("timestamp_ntz")
    wall = day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col(seconds).cast("decimal(18,6)"))
    return F.convert_timezone(col(tz) if isinstance(tz, Column) else F.lit(tz), F.lit("UTC"), wall)


def iso_boundary(text, tz: str) -> Column:
    """An ISO instant in UTC wall time: a zoned text is converted, a naive one is wall time of ``tz``."""
    value = col(text)
    zoned = value.rlike("(Z|[+-]\\d\\d:?\\d\\d)$")
    aware = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(value).cast("timestamp_ntz"))
    return F.when(zoned, aware).otherwise(F.convert_timezone(F.lit(tz), F.lit("UTC"), value.try_cast("timestamp_ntz")))


def civil_timestamp(parts: Column, tz: str) -> Column:
    """UTC wall time of (year, month, day, hour, minute, second) in a zone; bad parts give null."""
    whole = F.try_make_timestamp_ntz(parts["year"], parts["month"], parts["day"], *(F.coalesce(parts[k], F.lit(0)) for k in ("hour", "minute")), F.coalesce(parts["second"], F.lit(0)).cast("decimal(8,6)"))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), whole)


def delay_seconds(scheduled, realtime) -> Column:
    """Whole seconds late; null if either is missing or there is no delay."""
    gap = F.timestamp_diff("SECOND", col(scheduled), col(realtime))
    return F.nullif(gap, F.lit(0))


def transfer_key(*cols) -> Column:
    """Six ids joined by the unit separator; a missing one counts as empty."""
    return F.concat_ws(chr(31), *(F.coalesce(col(c), F.lit("")) for c in cols))


def content_key(cols: list, algorithm: str = "sha256", digits: int = 24, separator: str = "|") -> Column:
    """First hexadecimal digits of a hash of the joined columns."""
    joined = F.concat_ws(separator, *(col(c) for c in cols))
    return F.substr(F.sha1(joined.cast("binary")) if algorithm == "sha1" else F.sha2(joined.cast("binary"), 256), F.lit(1), F.lit(digits))


def optional_text(c) -> Column:
    """Trimmed text; empty and the usual words for nothing are null."""
    v = F.trim(col(c))
    return F.when(~F.lower(v).isin("", "none", "null", "nan"), v)


# Names of numeric trip and stop relationships.
RELATIONSHIPS = {
    "trip": {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "DUPLICATED", 6: "DELETED"},
    "stop": {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"},
}


def relationship_name(c, kind: str) -> Column:
    """Name of a relationship number; null counts as 0."""
    table = F.create_map(*(F.lit(x) for pair in RELATIONSHIPS[kind].items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.coalesce(col(c).cast("int"), F.lit(0))), F.lit("UNKNOWN"))


def localised_text(arr) -> tuple[Column, Column]:
    """Cleaned (language, text) list, and the last text of each language."""
    cleaned = F.filter(F.transform(col(arr), lambda x: F.struct(F.coalesce(F.trim(x["language"]), F.lit("")).alias("language"), F.trim(x["text"]).alias("text"))), lambda x: x["text"] != "")
    languages = F.array_distinct(F.transform(cleaned, lambda x: x["language"]))
    last = F.transform(languages, lambda k: F.element_at(F.transform(F.filter(cleaned, lambda x: x["language"] == k), lambda x: x["text"]), -1))
    return cleaned, F.map_from_arrays(languages, last)


# Names under which SQL sees the functions above, with arguments and body.
SQL_FUNCTIONS = {
    "tx_search_name": ("s STRING", "STRING", "trim(replace(replace(replace(replace(lower(s),'ä','ae'),'ö','oe'),'ü','ue'),'ß','ss'))"),
    "tx_service_seconds": ("s STRING", "INT", "CASE WHEN size(split(trim(s),':'))=3 AND try_cast(split(trim(s),':')[0] AS INT)>=0 AND try_cast(split(trim(s),':')[1] AS INT) BETWEEN 0 AND 59 AND try_cast(split(trim(s),':')[2] AS INT) BETWEEN 0 AND 59 THEN try_cast(split(trim(s),':')[0] AS INT)*3600+try_cast(split(trim(s),':')[1] AS INT)*60+try_cast(split(trim(s),':')[2] AS INT) END"),
    "tx_line_label": ("short STRING, long STRING, id STRING", "STRING", "coalesce(nullif(trim(short),''), nullif(trim(long),''), id)"),
    "tx_location_type": ("s STRING", "INT", "CASE WHEN try_cast(trim(s) AS INT) BETWEEN 0 AND 4 THEN try_cast(trim(s) AS INT) ELSE 0 END"),
    "tx_haversine_m": ("a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", "DOUBLE", "2*6371000.0D*asin(least(1.0D, sqrt(pow(sin((radians(c)-radians(a))/2),2)+cos(radians(a))*cos(radians(c))*pow(sin((radians(d)-radians(b))/2),2))))"),
    "tx_grid_cell": ("x DOUBLE, size DOUBLE", "BIGINT", "floor(x/size)"),
    "tx_optional_text": ("s STRING", "STRING", "CASE WHEN lower(trim(s)) NOT IN ('','none','null','nan') THEN trim(s) END"),
    "tx_bearing_diff": ("a DOUBLE, b DOUBLE", "DOUBLE", "least(abs(a-b)%360, 360-abs(a-b)%360)"),
}


def register_functions(spark) -> list[str]:
    """Defines the SQL functions for this session; no Python runs in them."""
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}")
    return sorted(SQL_FUNCTIONS)
