"""strftime templates: on a timestamp column, and resolved to one path.

A directive table replaces a script runtime: unknown directives are an error,
never passed through.  Between ``%`` and the letter may stand flags (``-`` no
padding, ``0`` and ``_`` padding by zeros and spaces, ``^`` capitals, ``#`` the
other case), a width (of a fraction of a second: its digits), and one or two
colons for ``%z``.  What a flag can't do to a directive is an error, too.
"""

from __future__ import annotations

import calendar
import datetime as _dt
import itertools
import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strftime directive -> Spark datetime pattern letters.
PATTERN_DIRECTIVES = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd",
    "H": "HH", "I": "hh", "M": "mm", "S": "ss", "L": "SSS",
    "b": "MMM", "B": "MMMM", "a": "E", "A": "EEEE", "p": "a",
    "j": "DDD", "z": "xx", "Z": "z",
}
# Composite directives.
COMPOSED_DIRECTIVES = {
    "F": "%Y-%m-%d", "T": "%H:%M:%S", "D": "%m/%d/%y", "R": "%H:%M", "r": "%I:%M:%S %p", "X": "%H:%M:%S",
    "x": "%m/%d/%y", "c": "%a %b %e %H:%M:%S %Y", "v": "%e-%^b-%Y", "h": "%b",
    "e": "%_d", "k": "%_H", "l": "%_I", "P": "%#p", "n": "\n", "t": "\t",
}
# Directives computed from functions (date_format has no letter).
FUNCTION_DIRECTIVES = ("s", "u", "w", "U", "W", "V", "C", "G", "g", "N")
# Digits of each numeric directive, and directives that are words.
_DIGITS = {"Y": 4, "y": 2, "m": 2, "d": 2, "H": 2, "I": 2, "M": 2, "S": 2, "L": 3, "j": 3, "u": 1, "w": 1, "U": 2, "W": 2, "V": 2,
           "C": 2, "G": 4, "g": 2, "N": 9}
_WORDS = "aAbBpZ"

_TOKEN = re.compile(r"%([-0^#_]*)([1-9][0-9]*)?(:*)(.?)|([^%]+)", re.S)


class Shape(NamedTuple):
    """What flags and a width make of a directive: ``pad`` is "" for none; ``case`` is upper, lower or None."""

    letter: str
    pad: str
    width: int
    case: str | None = None
    colons: int = 0


def _shape(d: str, flags: str, width: int | None, colons: int) -> Shape | None:
    """The shape, or None where the flags can't be had."""
    case = "upper" if "^" in flags else None
    if "#" in flags:
        case = {"p": "lower", "Z": "lower"}.get(d, "upper")
    padding = [f for f in flags if f in "-0_"]
    if d == "z":
        return None if flags or width or colons > 2 else Shape(d, "", 0, None, colons)
    if colons or (d == "s" and (padding or width)) or (d in "LN" and padding):
        return None
    if d in "LN":
        return Shape(d, "0", width or _DIGITS[d])
    pad = {"-": "", "0": "0", "_": " "}[padding[-1]] if padding else "0" if d in _DIGITS else " "
    # without padding a width is none
    return Shape(d, pad, 0 if pad == "" else max(width or 0, _DIGITS.get(d, 0)) if pad == "0" else width or _DIGITS.get(d, 0), case if d in _WORDS else None)


def _split(template: str, upper: bool = False):
    for m in _TOKEN.finditer(template):
        flags, width, colons, d, lit = m.groups()
        if lit is not None:
            yield ("lit", lit)
        elif d == "":
            raise ValueError(f"dangling '%' in template {template!r}")
        elif d == "%" and m.group() == "%%":
            yield ("lit", "%")
        elif d in "ekl" and not colons and (flags.strip("^") or width):
            # padding of its own: that of the directive it stands for
            yield from _split(f"%_{flags}{width or ''}{COMPOSED_DIRECTIVES[d][-1]}")
        elif d in COMPOSED_DIRECTIVES and not colons and not flags.strip("^") and not width:
            yield from _split(COMPOSED_DIRECTIVES[d], upper or bool(flags))
        elif d in PATTERN_DIRECTIVES or d in FUNCTION_DIRECTIVES:
            if upper and d in _WORDS and "#" not in flags:
                flags += "^"
            shape = _shape(d, flags, int(width) if width else None, len(colons)) if flags or width or colons else d
            if shape is None:
                raise ValueError(f"unsupported flags or width of strftime directive {m.group()} in {template!r}")
            yield ("dir", d) if shape == d else ("shape", shape)
        else:
            raise ValueError(f"unsupported strftime directive %{d} in {template!r}")


def _tokens(template: str):
    """(kind, value) of each piece, composites expanded: ``lit`` a run of literal text, ``dir`` a directive letter,
    ``shape`` a directive with flags or a width."""
    for kind, run in itertools.groupby(_split(template), key=lambda t: t[0]):
        if kind == "lit":
            yield ("lit", "".join(v for _, v in run))
        else:
            yield from run


def _quote(lit: str) -> str:
    return "'" + lit.replace("'", "''") + "'"


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _piece(ts: Column, d: str) -> Column:
    """One directive.  ``hour`` and its like, and the date, read an NTZ value as it is; ``date_format`` would take it
    through the session zone, where a local time may not exist."""
    doy = F.dayofyear(ts)
    if d == "s":
        # the epoch of an instant; NTZ has none, so its wall clock counts as UTC
        wall = F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
        instant = F.unix_timestamp(ts.cast("timestamp"))
        return F.when(F.typeof(ts) == "timestamp", instant).otherwise(wall).cast("string")
    if d == "H":
        return _two(F.hour(ts))
    if d == "I":
        return _two((F.hour(ts) + 11) % 12 + 1)
    if d == "p":
        return F.when(F.hour(ts) < 12, F.lit("AM")).otherwise(F.lit("PM"))
    if d == "M":
        return _two(F.minute(ts))
    if d == "S":
        return _two(F.second(ts))
    if d == "u":
        return (F.weekday(ts) + 1).cast("string")
    if d == "w":
        return (F.dayofweek(ts) - 1).cast("string")
    if d == "V":
        return _two(F.weekofyear(ts))
    if d == "W":
        return _two(F.floor((doy + 6 - F.weekday(ts)) / 7))
    if d == "U":
        return _two(F.floor((doy + 7 - F.dayofweek(ts)) / 7))
    if d == "C":
        return _two(F.floor(F.year(ts) / 100))
    if d in "Gg":
        year = F.extract(F.lit("YEAROFWEEK"), ts)
        return F.lpad(year.cast("string"), 4, "0") if d == "G" else _two(F.pmod(year, F.lit(100)))
    if d == "N":
        return F.concat(F.date_format(ts, "SSSSSS"), F.lit("000"))
    if d in _DATE_DIRECTIVES:
        return F.date_format(ts.cast("date"), PATTERN_DIRECTIVES[d])
    return F.date_format(ts, PATTERN_DIRECTIVES[d])  # milliseconds and zone


def _shaped(ts: Column, shape: Shape) -> Column:
    """One directive with its flags and width."""
    d, pad, width, case, colons = shape
    if d in "LN":
        return F.rpad(_piece(ts, "N"), width, "0")
    if d == "z":
        return F.date_format(ts, "xxx") if colons == 1 else F.concat(F.date_format(ts, "xxx"), F.lit(":00"))
    out = _piece(ts, d)
    if case:
        out = F.upper(out) if case == "upper" else F.lower(out)
    if d in _DIGITS:
        out = F.regexp_replace(out, "^0+(?=.)", "")
    return F.lpad(out, F.greatest(F.length(out), F.lit(width)), pad) if pad and width else out


#: Directives that depend on the date alone; runs of them and literals are formatted at once.
_DATE_DIRECTIVES = "YymdbBaAj"


def strftime_col(ts: Column, template: str) -> Column:
    """Format a timestamp column with a strftime template, row by row, JVM-side."""
    pieces: list[Column] = []
    pattern = ""
    for kind, val in _tokens(template):
        if kind == "lit":
            pattern += _quote(val)
        elif kind == "dir" and val in _DATE_DIRECTIVES:
            pattern += PATTERN_DIRECTIVES[val]
        else:
            if pattern:
                pieces.append(F.date_format(ts.cast("date"), pattern))
                pattern = ""
            pieces.append(_piece(ts, val) if kind == "dir" else _shaped(ts, val))
    if pattern:
        pieces.append(F.date_format(ts.cast("date"), pattern))
    if not pieces:
        return F.lit("")
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def templated_path_column(ts: Column, template: str, rewind_seconds: int = 0) -> Column:
    """Path of each row's time: strftime(ts - rewind, template)."""
    shifted = ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(int(rewind_seconds)))
    return strftime_col(shifted, template)


def strftime_to_java(fmt: str) -> str:
    """Parsing pattern for to_timestamp from a strftime format (pattern directives only)."""
    out = ""
    for kind, val in _tokens(fmt):
        if kind == "lit":
            out += _quote(val)
        elif kind == "dir" and val in PATTERN_DIRECTIVES:
            out += PATTERN_DIRECTIVES[val]
        else:
            raise ValueError(f"directive %{val if kind == 'dir' else val.letter} cannot be used to parse{'' if kind == 'dir' else ' with flags or a width'}")
    return out


# ---- driver-side resolution of one path (a config value, not data) ----

_PY_DIRECTIVES = {
    "Y": lambda t: f"{t.year:04d}", "y": lambda t: f"{t.year % 100:02d}",
    "m": lambda t: f"{t.month:02d}", "d": lambda t: f"{t.day:02d}",
    "H": lambda t: f"{t.hour:02d}", "I": lambda t: f"{(t.hour % 12) or 12:02d}",
    "M": lambda t: f"{t.minute:02d}", "S": lambda t: f"{t.second:02d}",
    "L": lambda t: f"{t.microsecond // 1000:03d}",
    "b": lambda t: calendar.month_abbr[t.month], "B": lambda t: calendar.month_name[t.month],
    "a": lambda t: calendar.day_abbr[t.weekday()], "A": lambda t: calendar.day_name[t.weekday()],
    "p": lambda t: "AM" if t.hour < 12 else "PM",
    "j": lambda t: f"{t.timetuple().tm_yday:03d}",
    "z": lambda t: t.strftime("%z") or "+0000", "Z": lambda t: t.strftime("%Z") or "UTC",
    "s": lambda t: str(calendar.timegm(t.utctimetuple()) if t.tzinfo else calendar.timegm(t.timetuple())),
    "u": lambda t: str(t.isoweekday()), "w": lambda t: str(t.isoweekday() % 7),
    "U": lambda t: f"{(t.timetuple().tm_yday + 6 - t.isoweekday() % 7) // 7:02d}",
    "W": lambda t: f"{(t.timetuple().tm_yday + 6 - t.weekday()) // 7:02d}",
    "V": lambda t: f"{t.isocalendar()[1]:02d}",
    "C": lambda t: f"{t.year // 100:02d}", "N": lambda t: f"{t.microsecond:06d}000",
    "G": lambda t: f"{t.isocalendar()[0]:04d}", "g": lambda t: f"{t.isocalendar()[0] % 100:02d}",
}


def _resolved(t: _dt.datetime, kind: str, val) -> str:
    """One token of a template at a time."""
    if kind != "shape":
        return val if kind == "lit" else _PY_DIRECTIVES[val](t)
    d, pad, width, case, colons = val
    out = _PY_DIRECTIVES["N" if d == "L" else d](t)
    if d in "LN":
        return out[:width].ljust(width, "0")
    if d == "z":
        return f"{out[:3]}:{out[3:5]}" + (":00" if colons == 2 else "")
    out = out.upper() if case == "upper" else out.lower() if case else out
    if d in _DIGITS:
        out = out.lstrip("0") or "0"
    return out.rjust(width, pad) if pad else out


def resolve_template(template: str, now: _dt.datetime, rewind_seconds: int = 0) -> str:
    """One path: strftime(now - rewind, template).  ``now`` is injected."""
    t = now - _dt.timedelta(seconds=int(rewind_seconds))
    return "".join(_resolved(t, kind, val) for kind, val in _tokens(template))


def expand_template(template: str, start: _dt.datetime, end: _dt.datetime,
                    step_seconds: int = 86400) -> list[str]:
    """Distinct paths of a template over [start, end] in steps; order kept."""
    if step_seconds <= 0:
        raise ValueError("step_seconds must be > 0")
    seen, out, t = set(), [], start
    while t <= end:
        p = resolve_template(template, t)
        if p not in seen:
            seen.add(p)
            out.append(p)
        t += _dt.timedelta(seconds=step_seconds)
    return out


# ---- the inverse: what paths a template names, and the time that a path names ----

_NAMES = {"b": list(calendar.month_abbr)[1:], "B": list(calendar.month_name)[1:], "a": list(calendar.day_abbr),
          "A": list(calendar.day_name), "p": ["AM", "PM"]}


def template_glob(template: str, start: _dt.datetime | None = None, end: _dt.datetime | None = None) -> str:
    """A glob that matches every path of the template, or those from ``start`` to ``end`` and few others.

    Directives that are the same all over the span stand as they are, years that differ as alternatives.
    """
    fixed = ""
    if start is not None and end is not None:
        same = [start.year == end.year, (start.year, start.month) == (end.year, end.month), start.date() == end.date()]
        fixed = "".join(letters for ok, letters in zip(same, ("Yy", "mbB", "djaAuwUWVGg")) if ok)
    out = ""
    for kind, val in _tokens(template):
        letter = val.letter if kind == "shape" else val
        if kind == "lit":
            out += val
        elif letter in fixed:
            out += _resolved(start, kind, val)
        elif kind == "shape":
            out += "*"
        elif val == "Y" and start is not None and end is not None and end.year - start.year < 50:
            out += "{" + ",".join(f"{y:04d}" for y in range(start.year, end.year + 1)) + "}"
        elif val in _DIGITS:
            out += "[0-9]" * _DIGITS[val]
        else:
            out += "*"
    return out


def template_regex(template: str) -> tuple[str, list[str]]:
    """A regex of the paths of a template (globs in it allowed), a group per directive, and the directives in order."""
    out, letters, depth = "", [], 0
    for kind, val in _tokens(template):
        if kind == "shape":
            d, pad, width, case, colons = val
            letters.append(d)
            digits = _DIGITS.get(d, 0)
            if d in "LN":
                out += f"([0-9]{{{width}}})"
            elif digits:
                out += f"([{pad}0-9]{{{width},{max(width, digits)}}})" if pad else f"([0-9]{{1,{digits}}})"
            elif d in _NAMES:
                words = [w.upper() if case == "upper" else w.lower() if case else w for w in _NAMES[d]]
                out += "[ 0]*(" + "|".join(sorted(words, key=len, reverse=True)) + ")"
            else:
                out += "([^/]+)"
            continue
        if kind == "dir":
            letters.append(val)
            if val in _DIGITS:
                out += f"([0-9]{{{_DIGITS[val]}}})"
            elif val in _NAMES:
                out += "(" + "|".join(sorted(_NAMES[val], key=len, reverse=True)) + ")"
            else:
                out += {"s": "(-?[0-9]+)", "z": r"([+-][0-9]{4})"}.get(val, "([^/]+)")
            continue
        for c in val:
            if c == "{":
                out, depth = out + "(?:", depth + 1
            elif c == "}" and depth:
                out, depth = out + ")", depth - 1
            elif c == "," and depth:
                out += "|"
            else:
                out += {"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c))
    return out, letters


def path_time(path: Column, template: str) -> Column:
    """The wall-clock time (TIMESTAMP_NTZ) that a path of the template names; null for other paths.

    Parts that the template leaves out are the first of their kind.  A year and a day of the year, or the epoch,
    are enough; weekdays, weeks and zones must fit but say nothing.
    """
    regex, letters = template_regex(template)
    regex += "(?=/|$)"
    if not {"Y", "y", "s"} & set(letters):
        raise ValueError(f"template {template!r} has no year")

    def group(d):
        return F.regexp_extract(path, regex, letters.index(d) + 1) if d in letters else None

    def number(d):
        g = group(d)
        return None if g is None else g.try_cast("int")

    def first(*found):
        return next((x for x in found if x is not None), None)

    fits = path.rlike(regex)
    if "s" in letters:
        epoch = group("s").try_cast("long")
        wall = F.date_add(F.lit(_dt.date(1970, 1, 1)), F.floor(epoch / 86400).cast("int"))
        rest = F.pmod(epoch, F.lit(86400))
        return F.when(fits, F.try_make_timestamp_ntz(F.year(wall), F.month(wall), F.day(wall), (rest / 3600).cast("int"),
                                                     (rest % 3600 / 60).cast("int"), (rest % 60).cast("decimal(16,6)")))
    short = number("y")
    # two digits mean 1969 to 2068, as strptime reads them
    year = first(number("Y"), None if short is None else F.when(short < 69, short + 2000).otherwise(short + 1900))
    names = [None if group(d) is None else F.array_position(F.array(*[F.lit(n.lower()) for n in _NAMES[d]]), F.lower(group(d))).cast("int") for d in "bB"]
    month, day = first(number("m"), *names), number("d")
    if month is None and "j" in letters:
        date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), number("j") - 1)
        month, day = F.month(date), F.day(date)
    half = None if group("p") is None else F.upper(group("p"))
    twelve = None if number("I") is None else number("I") % 12 + (F.when(half == "PM", 12).otherwise(0) if half is not None else 0)
    parts = [F.concat(F.lit("0."), group(d)).try_cast("decimal(16,6)") for d in "LN" if d in letters]
    second = first(number("S"), F.lit(0)).cast("decimal(16,6)") + first(*parts, F.lit(0).cast("decimal(16,6)"))
    return F.when(fits, F.try_make_timestamp_ntz(year, first(month, F.lit(1)), first(day, F.lit(1)), first(number("H"), twelve, F.lit(0)),
                                                 first(number("M"), F.lit(0)), second.cast("decimal(16,6)")))


def truncated(t: _dt.datetime, template: str) -> _dt.datetime:
    """The time that the template's path of ``t`` names."""
    found = {v if k == "dir" else v.letter: 0 if k == "dir" else v.width for k, v in _tokens(template) if k != "lit"}
    letters = set(found)
    if "s" in letters:
        return t.replace(microsecond=0)
    parts = {"month": ("mbBj", 1), "day": ("dj", 1), "hour": ("HI", 0), "minute": ("M", 0), "second": ("S", 0)}
    t = t.replace(**{part: low for part, (named, low) in parts.items() if not letters & set(named)})
    digits = [min(found[d] or _DIGITS[d], 6) for d in "LN" if d in letters]
    step = 10 ** (6 - digits[0]) if digits else 1_000_000
    return t.replace(microsecond=t.microsecond // step * step)
