"""Column expressions shared by the operators; every function maps columns to a column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from plantflow.config import SHIFT_HOURS, SHIFTS, Shift

# Everything that counts as white space between words, ASCII or not.
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NOT_BLANK = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value worked out once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- repair ---------------------------------------------------------------


def nan_to_null(c: Column | str) -> Column:
    """NaN means "missing" in the inputs, which SQL spells NULL."""
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def normalise_label(c: Column | str) -> Column:
    """Strip blanks (tabs too) at both ends and upper-case; NULL stays NULL."""
    return F.upper(F.regexp_replace(as_column(c), rf"^{BLANK}+|{BLANK}+$", ""))


def lenient_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(as_column(c).cast("string"))


def lenient_date(c: Column | str) -> Column:
    return as_column(c).cast("string").try_cast("date")


def lenient_double(c: Column | str) -> Column:
    return nan_to_null(as_column(c).try_cast("double"))


def outside(c: Column | str, low: float, high: float) -> Column:
    """True for a value beyond its valid range; NULL counts as not outside."""
    c = as_column(c)
    return F.coalesce((c < low) | (c > high), F.lit(False))


def within(c: Column | str, low: float, high: float) -> Column:
    """The value, or NULL when it is beyond its valid range."""
    c = as_column(c)
    return F.when(c.between(low, high), c)


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to a range; NULL stays NULL (greatest/least alone would skip it)."""
    c = as_column(c)
    limited = c
    if low is not None:
        limited = F.greatest(limited, F.lit(float(low)))
    if high is not None:
        limited = F.least(limited, F.lit(float(high)))
    return F.when(c.isNotNull(), limited)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """A ratio that is 0 when there is nothing to divide by."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / F.nullif(denominator, F.lit(0)))


# --- shifts ---------------------------------------------------------------


def shift_name(ts: Column | str, shifts: Sequence[Shift] = SHIFTS) -> Column:
    """Name of the shift an instant falls in; shifts may differ in length."""
    hour = F.hour(as_column(ts))
    name = F.lit("Unknown")
    for shift in reversed(shifts):
        if shift.overnight:
            inside = (hour >= shift.start_hour) | (hour < shift.end_hour)
        else:
            inside = (hour >= shift.start_hour) & (hour < shift.end_hour)
        name = F.when(inside, F.lit(shift.name)).otherwise(name)
    return name


def shift_date(ts: Column | str, shifts: Sequence[Shift] = SHIFTS) -> Column:
    """Calendar day on which the instant's shift started."""
    ts = as_column(ts)
    day = F.to_date(ts)
    for shift in shifts:
        if shift.overnight:
            tail = (shift_name(ts, shifts) == shift.name) & (F.hour(ts) < shift.end_hour)
            day = F.when(tail, F.date_sub(F.to_date(ts), 1)).otherwise(day)
    return day


def shift_start(date: Column | str, shift: Column | str, shifts: Sequence[Shift] = SHIFTS) -> Column:
    """Instant at which the shift of a calendar day begins (NULL for an unknown shift)."""
    hours = F.create_map(*[F.lit(v) for s in shifts for v in (s.name, s.start_hour)])
    midnight = as_column(date).cast("timestamp")
    return midnight + F.make_dt_interval(F.lit(0), F.try_element_at(hours, as_column(shift)))


def shift_order(shift: Column | str, shifts: Sequence[Shift] = SHIFTS) -> Column:
    """Position of the shift within its day."""
    places = F.create_map(*[F.lit(v) for i, s in enumerate(shifts) for v in (s.name, i)])
    return F.try_element_at(places, as_column(shift))


def sim_day(date: Column | str, start: str) -> Column:
    """Day number, 1 on the first day of the record."""
    return F.datediff(as_column(date), F.lit(start).cast("date")) + 1


# --- production -----------------------------------------------------------


def downtime_ratio(minutes: Column | str, hours: float = SHIFT_HOURS) -> Column:
    return clip(as_column(minutes) / (hours * 60.0), 0.0, 1.0)


def production_efficiency(count: Column | str, minutes: Column | str, hours: float = SHIFT_HOURS) -> Column:
    """Units per running hour; 0 for a shift that was down throughout or has no downtime figure."""
    minutes = as_column(minutes)
    running = clip(F.lit(float(hours)) - minutes / 60.0, low=0.1)
    return F.when(downtime_ratio(minutes, hours) < 1, as_column(count) / running).otherwise(F.lit(0.0))


# --- risk and money -------------------------------------------------------


def risk_level(p: Column | str, threshold: Column | float) -> Column:
    """HIGH from the threshold on, LOW below half of it, MEDIUM between."""
    p = as_column(p)
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(p >= cut, "HIGH").when(p < cut / 2, "LOW").when(p.isNotNull(), "MEDIUM")


def compounded_risk(p: Column | str, shifts: Column | float) -> Column:
    """Chance of at least one failure over independent shifts."""
    n = shifts if isinstance(shifts, Column) else F.lit(float(shifts))
    return 1.0 - F.pow(1.0 - as_column(p), F.greatest(F.lit(0.0), n))


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(x, -30.0, 30.0)))


def direction(contribution: Column | str) -> Column:
    return F.when(as_column(contribution) > 0, "increases_risk").otherwise("decreases_risk")


def percent(c: Column | str) -> Column:
    """A share as text with one decimal, such as 12.5%, rounded by the exact binary value.

    Twenty times the value is summed with its rounding error, so a value that
    only looks like a tie (most do) goes to the side it really lies on, and a
    true tie goes to the even digit.
    """
    value = as_column(c) * 100.0
    large, small = value * 16.0, value * 4.0
    total = large + small
    back = total - large
    error = (large - (total - back)) + (small - back)
    low = F.floor(total / 2.0).cast("double")
    over = total - 2.0 * low
    up = F.when(over == 1.0, (error > 0) | ((error == 0) & (low % 2 == 1))).otherwise(over > 1.0)
    return F.format_string("%.1f%%", (low + F.when(up, 1.0).otherwise(0.0)) / 10.0)


def readable(c: Column | str) -> Column:
    """A column name as words."""
    return F.replace(as_column(c), F.lit("_"), F.lit(" "))


# --- text -----------------------------------------------------------------


def clean_text(c: Column | str) -> Column:
    """Lower case, letters and digits only, single blanks."""
    kept = F.regexp_replace(F.lower(as_column(c)), r"[^a-z0-9]+", " ")
    return F.trim(kept)


def words(c: Column | str) -> Column:
    """Words between white space, empty array for blank text."""
    return F.array_remove(F.split(as_column(c), rf"{BLANK}+"), "")


def tokens(c: Column | str, stop_words: Sequence[str] = (), pattern: str = r"(?U)\b\w\w+\b") -> Column:
    """Lower-case tokens of two or more word characters, without the stop words."""
    found = F.regexp_extract_all(F.lower(as_column(c)), F.lit(pattern), F.lit(0))
    if stop_words:
        found = F.filter(found, lambda t: ~t.isin(list(stop_words)))
    return found


def unigrams_and_bigrams(token_array: Column) -> Column:
    """The tokens followed by every pair of neighbours joined with a blank."""

    def both(tokens: Column) -> Column:
        fewer = F.greatest(F.size(tokens) - 1, F.lit(0))
        heads, tails = F.slice(tokens, F.lit(1), fewer), F.slice(tokens, F.lit(2), fewer)
        return F.concat(tokens, F.zip_with(heads, tails, lambda a, b: F.concat(a, F.lit(" "), b)))

    return bound(token_array, both)


def l2_norm(vector: Column) -> Column:
    """Length of a dense vector; 1 for a zero vector so that it can divide."""
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(squares == 0, F.lit(1.0)).otherwise(F.sqrt(squares))


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)
