"""Personal numbers, dates and addresses replaced by format-preserving Feistel pseudonyms. SQL functions only.

A text is cut at the matches of one pattern; each match that its kind's test accepts is replaced by another value of the
same format, through a keyed Feistel network (eight rounds of SHA-256), and the text is joined again. The networks are
permutations: equal values get equal pseudonyms in all documents, different values of a kind different ones, and who has
the key can go back to the value. (Not to how it was written where one value can be written in several ways: leading zeros
of a date's parts, small and capital letters of an address.)

| kind | test | permuted |
|-|-|-|
| number of 13 to 19 digits, plain or in groups | Luhn | all digits but the last, which is worked out anew |
| phone number | 8 to 15 digits | digits after the country code |
| ddd-dd-dddd | area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999 | within the valid ones |
| IPv4 address | octets to 255 | 32 bits; octets in three digits if one has leading zeros |
| date: y-m-d, d/m/y, d.m.y, else m/d/y | a day of the years 1800 to 2199 | the day within these 400 years, 146,097 = 27 x 5,411 days; days of the month up to 12 and above among themselves, by walking the permutation's cycle, so that a m/d date never reads as another d/m date |
| hexadecimal key of 32 to 64 digits | a digit and a letter | each digit |
| e-mail address | local part of at most 64, domain of labels of at most 63 characters | the local part as if in lower case (all capitals stay capitals): letters stay letters, digits digits; the domain stays |

The pattern is matched in linear time and without recursion, whatever the text. Work is per document and per match: one
scan, no shuffle, whatever the skew. The key is read through a subquery of one row, so that plans, event logs and the
user interface show none of it.

Defined cases: a null text stays null with 0 replaced; an empty text stays empty; values that fail their test stay; null
``doc_id`` and repeated rows are treated like others; an empty table gives an empty result; other columns are returned as
they are; an empty or null key is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import boxed, table, unboxed

PATTERNS = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,20}+",
    r"(?<![0-9A-Za-z.])(?:\d{1,3}\.){3}\d{1,3}(?![0-9A-Za-z]|\.\d)",
    r"(?<![0-9-])\d{4}-\d{2}-\d{2}(?![0-9-])",
    r"(?<![0-9./])(?:\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![0-9/]|\.\d)",
    r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])",
    r"(?<![0-9A-Za-z])\d{13,19}(?![0-9A-Za-z])",
    r"(?<![0-9-])\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}(?!\d)",
    r"(?<![0-9-])\d{4}([ -])\d{6}\2\d{5}(?!\d)",
    r"(?<![0-9A-Za-z])\+(?:1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\d{1,3}[ .-]?\d{1,2}(?:[ .-]\d{2}){4}|\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})[ .-]?\d{3,4}(?:[ .-]?\d{3,4})?|\d{8,15})(?!\d)",
    r"(?<![0-9A-Za-z+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
)
PATTERN = "|".join(PATTERNS)
ROUNDS = 8
#: Steps along a cycle of the days' permutation; four in ten days are of the smaller class, so that 200 always suffice.
_WALK = 200
_BASE_DAY, _CYCLE, _LOW_DAYS = -62091, 146_097, 5_411  # 1800-01-01 in days since 1970; 400 years = 27 * 5,411 days


def _hash(tag: str, *parts: str) -> str:
    joined = ", ':', ".join(f"cast({p} as string)" for p in parts)
    return f"cast(conv(substr(sha2(concat(_key, '|{tag}|', {joined}), 256), 1, 15), 16, 10) as bigint)"


def numbers(a: str, b: str, mod_a: str, mod_b: str, tag: str) -> str:
    """Struct a, b: the pair permuted in [0, mod_a) x [0, mod_b)."""
    left = f"named_struct('a', pmod(s.a + {_hash(tag, 'i', 's.b')}, {mod_a}), 'b', s.b)"
    right = f"named_struct('a', s.a, 'b', pmod(s.b + {_hash(tag, 'i', 's.a')}, {mod_b}))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (s, i) -> if(i % 2 = 0, {left}, {right}))"


def digits(d: str, tag: str) -> str:
    """Digits of a string of 2 to 19 permuted, leading zeros kept."""
    n = f"length({d})"
    low = f"(length({d}) div 2)"
    pair = numbers(f"substr({d}, 1, {low})", f"substr({d}, {low} + 1)", f"cast(pow(10, {low}) as bigint)", f"cast(pow(10, {n} - {low}) as bigint)", tag)
    return f"transform(array({pair}), p -> concat(lpad(cast(p.a as string), {low}, '0'), lpad(cast(p.b as string), {n} - {low}, '0')))[0]"


def characters(text: str, tag: str, shift: str) -> str:
    """A string's halves shifted in turn, each character within its class, by what the other half hashes to.
    ``shift`` gives a character from ``c`` and ``k``."""

    def moved(half: str, other: str) -> str:
        return f"array_join(transform(split({half}, ''), (c0, j) -> transform(array(named_struct('c', c0, 'k', {_hash(tag, 'i', 'j', other)})), z -> {shift})[0]), '')"

    low = f"(length({text}) div 2)"
    step = f"if(i % 2 = 0, named_struct('a', if(s.a = '', '', {moved('s.a', 's.b')}), 'b', s.b), named_struct('a', s.a, 'b', {moved('s.b', 's.a')}))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', substr({text}, 1, {low}), 'b', substr({text}, {low} + 1)), (s, i) -> {step}, s -> concat(s.a, s.b))"


_ALNUM = "case when z.c rlike '^[0-9]$' then chr(48 + pmod(ascii(z.c) - 48 + z.k, 10)) when z.c rlike '^[a-z]$' then chr(97 + pmod(ascii(z.c) - 97 + z.k, 26)) else z.c end"
_HEX = "substr('0123456789abcdef', cast(pmod(instr('0123456789abcdef', z.c) - 1 + z.k, 16) as int) + 1, 1)"


def _luhn(d: str) -> str:
    """Check digit for digits ``d`` (without it)."""
    two = "if((length(" + d + ") - u) % 2 = 1, cast(v as int) * 2, cast(v as int))"
    return f"(10 - aggregate(transform(split({d}, ''), (v, u) -> transform(array({two}), w -> if(w > 9, w - 9, w))[0]), 0, (x, y) -> x + y) % 10) % 10"


def _refill(m: str, d: str) -> str:
    """``m`` with its digits replaced, in order, by those of ``d``."""
    at = f"length(regexp_replace(substr({m}, 1, t + 1), '[^0-9]', ''))"
    return f"array_join(transform(split({m}, ''), (c, t) -> if(c rlike '^[0-9]$', substr({d}, {at}, 1), c)), '')"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _card(m: str) -> str:
    body = "substr(d, 1, length(d) - 1)"
    again = _bind(digits(body, "number"), "e", _bind(f"concat(e, cast({_luhn('e')} as string))", "f", _refill(m, "f")))
    return _bind(f"regexp_replace({m}, '[^0-9]', '')", "d", f"if(cast(substr(d, length(d), 1) as int) = {_luhn(body)}, {again}, null)")


def _phone(m: str) -> str:
    keep = f"case when {m} like '+1%' then 1 when {m} like '+%' then 2 else 0 end"
    again = _bind(f"concat(substr(d, 1, {keep}), {digits(f'substr(d, {keep} + 1)', 'phone')})", "f", _refill(m, "f"))
    return _bind(f"regexp_replace({m}, '[^0-9]', '')", "d", f"if(length(d) between 8 and 15, {again}, null)")


def _nine(m: str) -> str:
    """Areas 001 to 899 without 666 are 898, groups 99, serials 9,999."""
    area, group, serial = (f"cast(substr({m}, {at}, {n}) as int)" for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = f"{area} between 1 and 899 and {area} != 666 and {group} > 0 and {serial} > 0"
    pair = numbers(f"({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1", f"{serial} - 1", "88902", "9999", "nine")
    text = "concat(lpad(cast(p.a div 99 + if(p.a div 99 >= 665, 2, 1) as string), 3, '0'), '-', lpad(cast(p.a % 99 + 1 as string), 2, '0'), '-', lpad(cast(p.b + 1 as string), 4, '0'))"
    return f"if({valid}, {_bind(pair, 'p', text)}, null)"


def _ip(m: str) -> str:
    pair = numbers("cast(o[0] as int) * 256 + cast(o[1] as int)", "cast(o[2] as int) * 256 + cast(o[3] as int)", "65536", "65536", "ip")
    octets = "array(p.a div 256, p.a % 256, p.b div 256, p.b % 256)"
    text = f"array_join(transform({octets}, v -> if({m} rlike '(^|[.])0[0-9]', lpad(cast(v as string), 3, '0'), cast(v as string))), '.')"
    return _bind(f"split({m}, '[.]')", "o", f"if(exists(o, v -> cast(v as int) > 255), null, {_bind(pair, 'p', text)})")


def _day(y: str, mo: str, d: str) -> str:
    """Days since 1800-01-01, null if there is no such day or it lies beyond the 400 years."""
    day = f"unix_date(cast(try_to_timestamp(concat_ws('-', lpad({y}, 4, '0'), lpad({mo}, 2, '0'), lpad({d}, 2, '0')), 'yyyy-MM-dd') as date)) - ({_BASE_DAY})"
    return _bind(day, "z", f"if(z >= 0 and z < {_CYCLE}, z, null)")


def _date_of(v: str) -> str:
    return f"date_from_unix_date(cast({v} + ({_BASE_DAY}) as int))"


def _moved_day(n: str) -> str:
    """The day that ``n`` becomes: the next one on its cycle that lies on the same side of the 12th of its month."""
    pair = numbers(f"w.v div {_LOW_DAYS}", f"w.v % {_LOW_DAYS}", str(_CYCLE // _LOW_DAYS), str(_LOW_DAYS), "day")
    late = lambda v: f"(day({_date_of(v)}) > 12)"
    step = _bind(pair, "p", _bind(f"p.a * {_LOW_DAYS} + p.b", "x", f"named_struct('v', x, 'ok', {late('x')} = w.c, 'c', w.c)"))
    start = f"named_struct('v', cast({n} as bigint), 'ok', false, 'c', {late(n)})"
    return f"aggregate(sequence(1, {_WALK}), {start}, (w, j) -> if(w.ok, w, {step}), w -> w.v)"


def _date(y: str, mo: str, d: str, fmt: str) -> str:
    return _bind(_day(y, mo, d), "n", f"if(n is null, null, date_format({_date_of(_moved_day('n'))}, {fmt}))")


def _slashed(m: str) -> str:
    """d/m/y or d.m.y where that is a day, else m/d/y."""
    sep = f"if({m} like '%/%', '/', '.')"
    wide = f"{m} rlike '^[0-9]{{2}}.[0-9]{{2}}.'"
    day_first = f"if({wide}, concat_ws({sep}, 'dd', 'MM', 'yyyy'), concat_ws({sep}, 'd', 'M', 'yyyy'))"
    month_first = f"if({wide}, concat_ws({sep}, 'MM', 'dd', 'yyyy'), concat_ws({sep}, 'M', 'd', 'yyyy'))"
    both = f"coalesce({_date('q[2]', 'q[1]', 'q[0]', 'f')}, {_date('q[2]', 'q[0]', 'q[1]', 'g')})"
    return _bind(f"split({m}, '[./]')", "q", _bind(day_first, "f", _bind(month_first, "g", both)))


def _mail(m: str) -> str:
    local = characters("l", "mail", _ALNUM)
    return _bind(f"lower(substring_index({m}, '@', 1))", "l", f"concat(if({m} rlike '^[^a-z]*[A-Z][^a-z]*@', upper({local}), {local}), '@', substring_index({m}, '@', -1))")


def _hex(m: str) -> str:
    moved = characters("l", "hex", _HEX)
    return f"if({m} rlike '[A-F]', upper({_bind(f'lower({m})', 'l', moved)}), {_bind(m, 'l', moved)})"


def pseudonym(m: str) -> str:
    """SQL for the pseudonym of a match under the column ``_key``, or null if its kind's test fails."""
    iso = _bind(f"split({m}, '-')", "q", _date("q[0]", "q[1]", "q[2]", "'yyyy-MM-dd'"))
    return f"""case when {m} like '%@%' then {_mail(m)}
      when {m} rlike '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' then {_ip(m)}
      when {m} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' then {iso}
      when {m} rlike '^[0-9]{{1,2}}([/.])[0-9]{{1,2}}[/.][0-9]{{4}}$' then {_slashed(m)}
      when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then {_nine(m)}
      when {m} rlike '^[0-9]{{13,19}}$' or {m} rlike '^[0-9]{{4}}[ -][0-9]' then {_card(m)}
      when {m} rlike '^[+(0-9][-0-9 .()]*$' then {_phone(m)}
      when {m} rlike '[0-9]' and {m} rlike '[A-Fa-f]' then {_hex(m)} end"""


def pseudonymise(docs: DataFrame, key: str | DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text pseudonymised, and _replaced. ``key``: a text, or a table of one row and one
    column, which a secret store may guard."""
    keys = docs.sparkSession.createDataFrame([(key,)], "_key string") if isinstance(key, str) else key.toDF("_key")
    if not keys.filter(F.length("_key") > 0).limit(1).count():
        raise ValueError("a key is needed")
    t = F.col("_row")[text_col]
    some = t.rlike("[0-9@]")
    found = F.when(some, F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)))
    between = F.when(some, F.split(t, PATTERN, -1))
    d = boxed(docs).withColumn("_key", keys.scalar()).withColumn("_found", found).withColumn("_between", between)
    d = d.withColumn("_new", F.when(F.size("_found") > 0, F.expr(f"transform(_found, m -> {pseudonym('m')})")))
    pieces = F.transform(F.col("_between"), lambda p, i: F.concat(p, F.coalesce(F.get(F.col("_new"), i), F.get(F.col("_found"), i), F.lit(""))))
    out = d.withColumn(text_col, F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(t))
    replaced = F.coalesce(F.size(F.filter(F.col("_new"), lambda x: x.isNotNull())), F.lit(0))
    return unboxed(out.withColumn("_replaced", F.when(F.size("_found") > 0, replaced).otherwise(0)), docs.columns, text_col, "_replaced")


#: What op5_pii uses where the session names no secret: a demonstration, known to everybody.
DEMONSTRATION_KEY = "demonstration only"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.tidemark.pii.secret`` (Spark redacts settings of that name)."""
    key = spark.conf.get("spark.tidemark.pii.secret", DEMONSTRATION_KEY)
    p = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key)
    return p.select("doc_id", "text", F.col("_replaced").alias("n_replaced"))
