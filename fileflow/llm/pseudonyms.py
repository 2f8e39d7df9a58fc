"""PII pseudonyms: keyed Feistel permutations that keep the format.

Native only: DataFrame and SQL functions, no Python on the executors.

Found and validated in whole texts: card numbers (13 to 19 digits, single
spaces or dashes between groups, Luhn), US social security numbers, telephone
numbers (+country or (area) forms), IPv4 addresses, dates (ISO, and day or month
first with / or .), IBANs (mod 97) and mail addresses.  What fails its check
stays as it is.  Every place where a value can start is tried, with all ends at
a separator: kinds in their order, long values first (IBANs of their country's
length before others), so digits or capitals behind or in front of a value don't
hide it.  Of values that overlap the first is taken.  A value is replaced by another one of its format:

- cards keep their first digit and length and pass Luhn again;
- social security numbers stay valid (area, group and serial);
- telephone numbers keep the country code (numbers of +1 have 11 digits at most;
  digits that follow others after one separator count as theirs up to 15);
- IPv4 addresses map to IPv4 addresses;
- dates map to real dates of the 400 years from 1800, exactly 146,097 = 189 * 773
  days, so no walk around invalid ones is needed (day/month/year first; where
  only month/day/year is a date that order is kept, and such a pseudonym may
  look like a day-first one);
- IBANs keep country and the bank part's letters, and get new check digits;
- mail addresses keep domain, length and kinds of characters.

The digits are a number below a * b, split into one half modulo a and one
modulo b.  Each of ``ROUNDS`` rounds adds a keyed hash of one half to the other,
so every step, and all together, is a permutation: different values stay
different, and equal values (written with the same or other separators) get
equal pseudonyms in every document.  The key and the kind enter each hash.  For
mail addresses the halves of the local part shift each other's characters
inside their kind (digit, small or capital letter).

Defined results: null texts stay null, with counts of 0; texts without PII stay
as they are; other columns travel along, those with the added names are
replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import fresh_name, table, without

ROUNDS = 8
#: What each kind looks like, in the order in which they are tried.
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9.-]{0,251}[A-Za-z0-9])?\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9.:/-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])(?!\.[0-9])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
             r"|(?<![0-9A-Za-z+(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
KINDS = tuple(PATTERNS)
#: All kinds, cards before the shorter kinds that can start like them.
ANY = "|".join(f"(?:{PATTERNS[k]})" for k in ("mail", "iban", "card", "date", "ipv4", "ssn", "phone"))
#: Every match has one of these; looking for them first is cheap.
HINT = r"[0-9][0-9 ./:)(-]{5}|@[A-Za-z0-9]|[A-Z]{2}[0-9]{2}"
#: Length of IBANs by country.
IBAN_LENGTHS = {int(x[:2]): x[3:].split() for x in (
    "15:NO", "16:BE", "18:DK FI FO GL NL", "19:MK SI", "20:AT BA EE KZ LT LU XK", "21:CH HR LI LV", "22:BG BH CR DE GB GE IE ME RS VA",
    "23:AE GI IL IQ", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:PT", "26:IS TR", "27:FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB PL",
    "29:BR PS QA UA", "30:JO KW MU", "31:MT", "32:LC")}
#: Characters of the longest value, a mail address.
LONGEST = 343
DAYS = 146_097  # of 400 years
EPOCH = "1800-01-01"


def _sql(text: str) -> str:
    """A SQL string literal."""
    return "r'" + text.replace("'", "\\'") + "'" if "'" not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, kind: str, round_: str, half: str, modulus: str) -> str:
    """Keyed hash of a half, below ``modulus``: 60 bits of SHA-256."""
    told = f"concat({_sql(key)}, '|', {kind}, '|', cast({round_} as string), '|', cast({half} as string))"
    return f"pmod(cast(conv(substr(sha2({told}, 256), 1, 15), 16, 10) as bigint), {modulus})"


def feistel(x: str, a: str, b: str, kind: str, key: str) -> str:
    """SQL for a keyed permutation of the numbers below a * b."""
    u, v = f"cast(({x}) div ({b}) as bigint)", f"cast(({x}) % ({b}) as bigint)"
    even = f"named_struct('u', pmod(fs.u + {_hash(key, kind, 'fr', 'fs.v', a)}, {a}), 'v', fs.v)"
    odd = f"named_struct('u', fs.u, 'v', pmod(fs.v + {_hash(key, kind, 'fr', 'fs.u', b)}, {b}))"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('u', pmod({u}, {a}), 'v', pmod({v}, {b})), "
            f"(fs, fr) -> if(fr % 2 = 1, {even}, {odd}), fs -> fs.u * ({b}) + fs.v)")


def _power(n: str) -> str:
    return f"cast(element_at(array({', '.join(str(10**k) + 'L' for k in range(19))}), cast({n} as int) + 1) as bigint)"


def digits_permuted(d: str, kind: str, key: str) -> str:
    """SQL for the digit string ``d`` (1 to 18 digits), permuted among those of its length."""
    n = f"length({d})"
    high, low = _power(f"{n} - {n} div 2"), _power(f"{n} div 2")
    told = f"concat({kind}, cast({n} as string))"
    return f"lpad(cast({feistel(f'cast({d} as bigint)', high, low, told, key)} as string), {n}, '0')"


def _luhn(d: str) -> str:
    """SQL for the Luhn sum of a digit string."""
    place = f"length({d}) - i"
    digit = f"cast(substr({d}, i, 1) as int)"
    return (f"aggregate(sequence(1, length({d})), 0, (t, i) -> t + if(({place}) % 2 = 1, "
            f"if({digit} > 4, 2 * {digit} - 9, 2 * {digit}), {digit}))")


def _laid_out(m: str, new: str) -> str:
    """SQL: ``m`` with its digits replaced by those of ``new``, in order; the rest stays."""
    before = f"length(regexp_replace(substr({m}, 1, i), '[^0-9]', ''))"
    return (f"array_join(transform(sequence(1, length({m})), i -> if(substr({m}, i, 1) between '0' and '9', "
            f"substr({new}, {before}, 1), substr({m}, i, 1))), '')")


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _mod97(s: str) -> str:
    """SQL for an IBAN-like string (letters are 10 to 35) modulo 97, ``s`` already rearranged."""
    c = f"substr({s}, i, 1)"
    return (f"aggregate(sequence(1, length({s})), 0, (t, i) -> if({c} between '0' and '9', "
            f"(t * 10 + cast({c} as int)) % 97, (t * 100 + ascii({c}) - 55) % 97))")


def replacements(key: str) -> dict[str, tuple[str, str]]:
    """For each kind SQL over a match ``m``: whether it is valid, and its pseudonym."""
    digits = "regexp_replace(m, '[^0-9]', '')"
    out = {}
    # cards: the first digit stays, the last is the check digit
    body = digits_permuted("substr(d, 2, length(d) - 2)", "'card'", key)
    first = _let(f"concat(substr(d, 1, 1), {body})", "p",
                 f"concat(p, cast(pmod(10 - {_luhn('concat(p, ' + chr(39) + '0' + chr(39) + ')')} % 10, 10) as string))")
    out["card"] = (_let(digits, "d", f"length(d) between 13 and 19 and {_luhn('d')} % 10 = 0"), _let(digits, "d", _let(first, "q", _laid_out("m", "q"))))
    # social security numbers: 898 areas, 99 groups, 9999 serials
    area, group, serial = "cast(substr(m, 1, 3) as bigint)", "cast(substr(m, 5, 2) as bigint)", "cast(substr(m, 8, 4) as bigint)"
    out["ssn"] = (f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0",
                  _let(feistel(f"((({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1) * 9999 + {serial} - 1)", "88902L", "9999L", "'ssn'", key), "x",
                       "concat_ws('-', lpad(cast((x div 989901) + if(x div 989901 >= 665, 2, 1) as string), 3, '0'), "
                       "lpad(cast(x div 9999 % 99 + 1 as string), 2, '0'), lpad(cast(x % 9999 + 1 as string), 4, '0'))"))
    # telephone numbers: the digits behind the country code
    country = "regexp_extract(m, '^\\\\+[0-9]{1,3}(?![0-9])', 0)"
    rest = _let(f"substr(m, length({country}) + 1)", "t", _let(
        f"regexp_replace(t, '[^0-9]', '')", "d", _let(digits_permuted("d", f"concat('phone', {country})", key), "q", f"concat({country}, {_laid_out('t', 'q')})")))
    out["phone"] = (f"length({digits}) between 7 and if(m like '+1%', 11, 15)", rest)
    parts = "transform(split(m, '[.]'), x -> cast(x as bigint))"
    out["ipv4"] = ("forall(split(m, '[.]'), x -> cast(x as int) <= 255 and (length(x) = 1 or substr(x, 1, 1) <> '0'))",
                   _let(feistel(f"aggregate({parts}, 0L, (t, x) -> t * 256 + x)", "65536L", "65536L", "'ipv4'", key), "x",
                        "concat_ws('.', cast(x div 16777216 as string), cast(x div 65536 % 256 as string), "
                        "cast(x div 256 % 256 as string), cast(x % 256 as string))"))
    # dates: which of day and month comes first shows where only one reading is a date; else day first
    iso, dot = "substr(m, 5, 1) = '-'", "substr(m, 3, 1) = '.'"
    day_first = "concat_ws('-', substr(m, 7, 4), substr(m, 4, 2), substr(m, 1, 2))"
    month_first = "concat_ws('-', substr(m, 7, 4), substr(m, 1, 2), substr(m, 4, 2))"
    read = f"if({iso}, m, if({dot} or try_cast({day_first} as date) is not null, {day_first}, {month_first}))"
    day = f"datediff(try_cast({read} as date), date'{EPOCH}')"
    moved = f"date_add(date'{EPOCH}', cast({feistel(f'cast({day} as bigint)', '189L', '773L', chr(39) + 'date' + chr(39), key)} as int))"
    out["date"] = (f"coalesce({day} between 0 and {DAYS - 1}, false)",
                   _let(moved, "x", f"if({iso}, date_format(x, 'yyyy-MM-dd'), if({dot}, date_format(x, 'dd.MM.yyyy'), "
                                    f"if(try_cast({day_first} as date) is not null, date_format(x, 'dd/MM/yyyy'), date_format(x, 'MM/dd/yyyy'))))"))
    # IBANs: digits of the account part in runs of up to 18, then new check digits
    plain = "replace(m, ' ', '')"
    turned = lambda s: f"concat(substr({s}, 5), substr({s}, 1, 4))"
    account = "regexp_replace(substr(s, 5), '[^0-9]', '')"
    run = lambda at, n: f"if(length({account}) > {at}, {digits_permuted(f'substr({account}, {at + 1}, {n})', f'concat({chr(39)}iban{at}{chr(39)}, substr(s, 1, 2))', key)}, '')"
    new = f"concat(substr(s, 1, 2), '00', {_let(f'concat({run(0, 15)}, {run(15, 15)})', 'q', _laid_out('substr(s, 5)', 'q'))})"
    check = _let(new, "p", f"concat(substr(p, 1, 2), lpad(cast(98 - {_mod97(turned('p'))} as string), 2, '0'), substr(p, 5))")
    spaced = _let(check, "w", "array_join(transform(sequence(1, length(m)), i -> if(substr(m, i, 1) = ' ', ' ', "
                              "substr(w, length(replace(substr(m, 1, i), ' ', '')), 1))), '')")
    out["iban"] = (_let(plain, "s", f"length(s) between 15 and 34 and {_mod97(turned('s'))} = 1"), _let(plain, "s", spaced))
    out["mail"] = ("true", _let("substring_index(m, '@', 1)", "t", f"concat({_shifted('t', key)}, substr(m, length(t) + 1))"))
    return out


def _shifted(t: str, key: str) -> str:
    """SQL for a string whose halves shift each other's characters inside their kind (digit, small, capital)."""
    def moved(half, by):
        told = f"concat({_sql(key)}, '|mail|', cast(r as string), '|', cast(i as string), '|', {by})"
        step = f"cast(conv(substr(sha2({told}, 256), 1, 8), 16, 10) as bigint)"
        c = f"substr({half}, i, 1)"
        turn = lambda low, n: f"char({low} + (ascii({c}) - {low} + {step}) % {n})"
        return (f"if(length({half}) = 0, '', array_join(transform(sequence(1, greatest(length({half}), 1)), i -> "
                f"case when {c} between '0' and '9' then {turn(48, 10)} when ascii({c}) between 97 and 122 then {turn(97, 26)} "
                f"when ascii({c}) between 65 and 90 then {turn(65, 26)} else {c} end), ''))")
    cut = f"length({t}) - length({t}) div 2"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('u', substr({t}, 1, {cut}), 'v', substr({t}, {cut} + 1)), "
            f"(s, r) -> if(r % 2 = 1, named_struct('u', {moved('s.u', 's.v')}, 'v', s.v), named_struct('u', s.u, 'v', {moved('s.v', 's.u')})), "
            f"s -> concat(s.u, s.v))")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with valid PII in ``text`` replaced, and the number replaced of each kind (``n_card`` and so on).

    A text is cut where values can start, each start gets the best value there
    (or none), the first of overlapping ones are taken and the pieces are joined
    again.
    """
    counts = [f"n_{k}" for k in KINDS]
    columns = [c for c in docs.columns if c.lower() not in counts]
    docs = without(docs, counts)
    cut, found, taken = (fresh_name(docs, c) for c in ("_cut", "_found", "_taken"))
    rules = replacements(key)
    # m is a window of the longest match f at its start, with one character in front (b) and two behind
    fits = lambda k: f"concat(b, m, substr(concat(f, '  '), e + 1, 2)) rlike {_sql('(?s)^.(?:' + PATTERNS[k] + ')(?=..' + chr(92) + 'z)')}"
    rank = "case " + " ".join(f"when {fits(k)} and {rules[k][0]} then {i}" for i, k in enumerate(KINDS)) + " end"
    length = "case " + " ".join(f"when substr(m, 1, 2) in ({', '.join(map(repr, cs))}) then {n}" for n, cs in IBAN_LENGTHS.items()) + " else 0 end"
    other = f"if(substr(m, 1, 2) rlike '^[A-Z]{{2}}' and length(replace(m, ' ', '')) <> {length}, 1, 0)"
    ends = "filter(sequence(length(f), 1, -1), e -> e = length(f) or (substr(f, e + 1, 1) rlike '[ ./-]' and substr(f, e, 1) rlike '[0-9A-Za-z]'))"
    best = (f"array_min(filter(transform({ends}, e -> {_let('substr(f, 1, e)', 'm', f'struct({rank} as r, {other} as o, -e as e, m as m)')}), "
            "x -> x.r is not null))")
    before = f"if(j + size({cut}) = size(all), ' ', right({cut}[j + size({cut}) - size(all) - 1], 1))"
    tried = _let(f"regexp_extract_all(`{text}`, {_sql('(?=(' + ANY + '))')}, 1)", "all",
                 "transform(all, (f, j) -> " + _let(before, "b", best) + ")")
    some = F.col(text).rlike(HINT)
    rows = docs.withColumn(cut, F.when(some, F.expr(f"split(`{text}`, {_sql('(?=' + ANY + ')')}, -1)")))
    rows = rows.withColumn(found, F.when(some, F.expr(tried)))
    # k pieces behind piece i begin inside its value; a regex goes from left to right over units (k, i) and skips those k
    first = f"(size({cut}) - size({found}))"
    at = f"{found}[i - {first}]"
    inside = _let(at, "x", f"if(x is null, 0, aggregate(sequence(i, cast(least(i - x.e, size({cut})) as int) - 1), struct(0 as at, -1 as k), "
                           f"(s, j) -> struct(s.at + length({cut}[j]) as at, s.k + if(s.at < -x.e, 1, 0) as k), s -> s.k))")
    unit = f"concat(lpad(cast({inside} as string), 3, '0'), lpad(cast(i as string), 10, '0'))"
    walk = "|".join(f"{k:03d}.{{{10 + 13 * k}}}" for k in range(LONGEST))
    tokens = f"regexp_extract_all(array_join(transform(sequence({first}, size({cut}) - 1), i -> {unit}), ''), '{walk}', 0)"
    own = f"array_join(transform(sequence(i, i + length(t) div 13 - 1), j -> {cut}[j]), '')"
    value = _let("cast(substr(t, 4, 10) as int)", "i", _let(at, "x", f"struct(cast(x.r as int) as r, x.m as m, substr({own}, coalesce(-x.e, 0) + 1) as rest)"))
    none = "cast(array() as array<struct<r:int,m:string,rest:string>>)"
    rows = rows.withColumn(taken, F.when(F.exists(found, lambda x: x.isNotNull()), F.expr(f"transform({tokens}, t -> {value})")).otherwise(F.expr(none)))
    new = "case x.r " + " ".join(f"when {i} then {_let('x.m', 'm', rules[k][1])}" for i, k in enumerate(KINDS)) + " else '' end"
    joined = F.expr(f"concat(if({first} = 1, {cut}[0], ''), array_join(transform({taken}, x -> concat({new}, x.rest)), ''))")
    out = [F.when(F.size(taken) > 0, joined).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    return rows.select(*out, *[F.expr(f"size(filter({taken}, x -> x.r = {i}))").alias(f"n_{k}") for i, k in enumerate(KINDS)])


def op7_pseudonyms(spark: SparkSession, sf_dir: str, key: str = "a production key comes from a secret store") -> DataFrame:
    """All ``documents`` with PII replaced by pseudonyms: doc_id, text and a count for each kind."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
