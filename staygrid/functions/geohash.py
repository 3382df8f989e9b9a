"""Geohash cells as pure Column arithmetic (JVM-side, inside whole-stage codegen).

A cell of ``bits`` bits is the pair of axis indexes (x for longitude with ceil(bits/2) bits,
y for latitude with floor(bits/2) bits); its code interleaves them starting with the
longitude bit, which is the order in which a repeated bisection of the two ranges emits
bits. A geohash text of p characters is the 5p-bit code written in the base-32 alphabet
below, so every shorter hash is a prefix of a longer one (code >> dropped bits).

The interleave reuses its input several times, so the DataFrame helpers (``with_*``) first
stage the axis indexes as columns and interleave those; Catalyst keeps the stages apart
instead of copying the index expression into every use. All results are NULL for NULL,
NaN or out-of-range coordinates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the geohash format (standard base-32 geohash alphabet and limits).
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
MAX_CHARS = 12
MAX_BITS = 60          # 12 characters; keeps every code a non-negative LONG

# Digits Spark's ``conv`` uses for radix 32; translating them maps conv output onto ALPHABET.
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"



def _spread8(b: int) -> int:
    return sum(((b >> i) & 1) << (2 * i) for i in range(8))


def _even4(b: int) -> int:
    return sum(((b >> (2 * i)) & 1) << i for i in range(4))


# Byte-wise lookup tables built by rule: spread a byte's bits to the even positions of 16
# bits, and gather the even bits of a byte into a nibble.
_SPREAD8 = [_spread8(b) for b in range(256)]
_EVEN4 = [_even4(b) for b in range(256)]


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def shr(v, n) -> Column:
    """Arithmetic right shift by an int or a Column amount."""
    return F.call_function("shiftright", _col(v), _c(n))


def shl(v, n) -> Column:
    return F.call_function("shiftleft", _col(v), _c(n))


def lng_bits(bits):
    return (bits + 1) // 2 if isinstance(bits, int) else F.shiftright(bits + 1, 1)


def lat_bits(bits):
    return bits // 2 if isinstance(bits, int) else F.shiftright(bits, 1)


def valid_point(lat: Column, lng: Column) -> Column:
    return (lat.isNotNull() & lng.isNotNull() & ~F.isnan(lat) & ~F.isnan(lng)
            & (F.abs(lat) <= 90.0) & (F.abs(lng) <= 180.0))


_TABLE_SQL: dict[int, str] = {}


def code_to_geohash(code, precision) -> Column:
    """Base-32 text of a 5p-bit code (p characters, leading zeros kept)."""
    text = F.translate(F.conv(_col(code).cast("string"), 10, 32), _CONV32, ALPHABET)
    return F.lpad(text, _c(precision), "0")


def geohash_to_code(gh) -> Column:
    """5p-bit code of a geohash text; NULL for empty text, text over 12 characters or a
    character outside the alphabet."""
    g = _col(gh)
    ok = g.rlike("^[0-9b-hjkmnp-z]{1,12}$")
    return F.when(ok, F.conv(F.translate(g, ALPHABET, _CONV32), 32, 10).cast("long"))


def cell_bounds(x, y, bits) -> dict[str, Column]:
    """South/north/west/east edges and centre of the cell (x, y) at ``bits`` bits."""
    h = F.lit(180.0) / F.pow(F.lit(2.0), _c(lat_bits(bits)))
    w = F.lit(360.0) / F.pow(F.lit(2.0), _c(lng_bits(bits)))
    south = F.lit(-90.0) + _col(y) * h
    west = F.lit(-180.0) + _col(x) * w
    return {"south": south, "north": south + h, "west": west, "east": west + w,
            "center_lat": south + h / 2, "center_lng": west + w / 2}


# ---------------------------------------------------------------- SQL-text builders
# The DataFrame helpers below build each cell expression as one SQL string (one parsed
# expression per column) instead of hundreds of Column calls.

def _n(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _d(v: float) -> str:
    return repr(float(v)) + "D"


def _bits_sql(bits) -> str:
    return str(int(bits)) if isinstance(bits, int) else _n(bits)


def lng_bits_sql(bits) -> str:
    return str((bits + 1) // 2) if isinstance(bits, int) else f"shiftright({_n(bits)} + 1, 1)"


def lat_bits_sql(bits) -> str:
    return str(bits // 2) if isinstance(bits, int) else f"shiftright({_n(bits)}, 1)"


def valid_point_sql(lat: str, lng: str) -> str:
    return (f"({lat} IS NOT NULL AND {lng} IS NOT NULL AND NOT isnan({lat}) AND NOT isnan({lng}) "
            f"AND abs({lat}) <= 90.0D AND abs({lng}) <= 180.0D)")


def axis_index_sql(v: str, lo: float, span: float, nbits_sql: str) -> str:
    """Index of the bisection interval holding ``v`` among 2^nbits equal intervals.

    ``floor`` of the scaled value can be off by one next to an interval edge; the edges
    lo + k*span/2^n are exact doubles, so comparing against them fixes the index exactly
    (a value on an edge belongs to the upper interval, as bisection keeps ``v >= mid`` up)."""
    cells = f"pow(2.0D, {nbits_sql})"
    top = f"CAST({cells} - 1 AS BIGINT)"
    k0 = f"least(greatest(CAST(floor(({v} - {_d(lo)}) / {_d(span)} * {cells}) AS BIGINT), 0L), {top})"
    width = f"({_d(span)} / {cells})"
    below = f"(CASE WHEN {v} < {_d(lo)} + {k0} * {width} THEN 1L ELSE 0L END)"
    above = f"(CASE WHEN {v} >= {_d(lo)} + ({k0} + 1) * {width} THEN 1L ELSE 0L END)"
    return f"least({k0} - {below} + {above}, {top})"


def _table_sql(values) -> str:
    key = id(values)
    if key not in _TABLE_SQL:
        _TABLE_SQL[key] = "array(" + ", ".join(f"{int(v)}L" for v in values) + ")"
    return _TABLE_SQL[key]


def _spread_sql(v: str) -> str:
    t = _table_sql(_SPREAD8)
    parts = [f"shiftleft(element_at({t}, CAST((shiftright({v}, {8 * j}) & 255L) + 1 AS INT)), {16 * j})"
             for j in range(4)]
    return "(" + " | ".join(parts) + ")"


def _compact_sql(v: str) -> str:
    t = _table_sql(_EVEN4)
    parts = [f"shiftleft(element_at({t}, CAST((shiftright({v}, {8 * j}) & 255L) + 1 AS INT)), {4 * j})"
             for j in range(8)]
    return "(" + " | ".join(parts) + ")"


def combine_sql(x: str, y: str, bits) -> str:
    sx, sy = _spread_sql(f"CAST({_n(x)} AS BIGINT)"), _spread_sql(f"CAST({_n(y)} AS BIGINT)")
    even, odd = f"(shiftleft({sx}, 1) | {sy})", f"({sx} | shiftleft({sy}, 1))"
    body = ((even if bits % 2 == 0 else odd) if isinstance(bits, int)
            else f"CASE WHEN {_n(bits)} % 2 = 0 THEN {even} ELSE {odd} END")
    return f"CASE WHEN {_n(x)} IS NOT NULL AND {_n(y)} IS NOT NULL THEN {body} END"


def split_sql(code: str, bits) -> tuple[str, str]:
    c = _n(code)
    hi = f"CASE WHEN {c} IS NOT NULL THEN {_compact_sql(f'shiftright({c}, 1)')} END"
    lo = f"CASE WHEN {c} IS NOT NULL THEN {_compact_sql(c)} END"
    if isinstance(bits, int):
        return (hi, lo) if bits % 2 == 0 else (lo, hi)
    even = f"{_n(bits)} % 2 = 0"
    return (f"CASE WHEN {even} THEN {hi} ELSE {lo} END", f"CASE WHEN {even} THEN {lo} ELSE {hi} END")


def code_to_geohash_sql(code: str, precision) -> str:
    p = str(int(precision)) if isinstance(precision, int) else _n(precision)
    return f"lpad(translate(conv(CAST({_n(code)} AS STRING), 10, 32), '{_CONV32}', '{ALPHABET}'), {p}, '0')"


# ---------------------------------------------------------------- DataFrame helpers

def with_cell_xy(df: DataFrame, lat: str, lng: str, bits, x: str = "_cx", y: str = "_cy") -> DataFrame:
    """Add the cell's axis indexes (NULL for unusable points); ``bits`` is an int or the
    name of an int column."""
    la, ln = _n(lat), _n(lng)
    ok = valid_point_sql(la, ln)
    xs = f"CASE WHEN {ok} THEN {axis_index_sql(ln, -180.0, 360.0, lng_bits_sql(bits))} END"
    ys = f"CASE WHEN {ok} THEN {axis_index_sql(la, -90.0, 180.0, lat_bits_sql(bits))} END"
    return df.withColumns({x: F.expr(xs), y: F.expr(ys)})


def with_cell_code(df: DataFrame, lat: str, lng: str, bits, out: str = "cell_code") -> DataFrame:
    """Add the right-aligned Z-order code of the ``bits``-bit cell (bits <= 60; an int or
    the name of an int column)."""
    if isinstance(bits, int) and not 0 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be in 0..{MAX_BITS}, got {bits}")
    cx, cy = "_cx_" + out, "_cy_" + out
    staged = with_cell_xy(df, lat, lng, bits, cx, cy)
    return staged.withColumn(out, F.expr(combine_sql(cx, cy, bits))).drop(cx, cy)


def with_geohash(df: DataFrame, lat: str, lng: str, precision: int, out: str = "geohash",
                 null_as_empty: bool = False) -> DataFrame:
    """Add the geohash text of ``precision`` characters (1..12).

    ``null_as_empty`` yields '' instead of NULL for unusable points, making the column
    non-nullable: use it after filtering ``valid_point`` when the hash becomes a join key,
    so the optimizer does not copy the whole cell expression into an inferred
    ``isnotnull`` filter below the projection.
    """
    p = int(precision)
    if not 1 <= p <= MAX_CHARS:
        raise ValueError(f"geohash precision must be in 1..{MAX_CHARS}, got {precision}")
    tmp = "_code_" + out
    text = code_to_geohash_sql(tmp, p)
    if null_as_empty:
        text = f"coalesce({text}, '')"
    return with_cell_code(df, lat, lng, 5 * p, tmp).withColumn(out, F.expr(text)).drop(tmp)


def with_split(df: DataFrame, code: str, bits, x: str, y: str) -> DataFrame:
    """Add the axis indexes of a code column; ``bits`` is an int or an int column name."""
    xs, ys = split_sql(code, bits)
    return df.withColumns({x: F.expr(xs), y: F.expr(ys)})


def with_combined(df: DataFrame, x: str, y: str, bits, out: str) -> DataFrame:
    """Add the code interleaved from axis-index columns ``x`` and ``y``."""
    return df.withColumn(out, F.expr(combine_sql(x, y, bits)))
