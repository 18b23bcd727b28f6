"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and validated (check digits, ranges, the calendar). A text with
one that does not validate gets a second look at every place and length that a value may have in it; what
does not validate then stays as it is. A valid value is permuted by a keyed Feistel network within
its own format: digits become digits in the same places, check digits are made right again, dates
stay dates of their century. The permutation depends on the key and the value alone, so equal
values -- also when written with other separators -- have equal pseudonyms in all
documents, and different values never share one.

Everything is SQL expressions; the key is a parameter and must be kept as a secret is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_WORD = r"\p{L}\p{N}"
_ALONE, _ENDS = rf"(?<![{_WORD}])", rf"(?![{_WORD}])"

#: Candidates, most specific first. Look-behinds and possessive repeats keep the search linear.
EMAIL = rf"(?<![{_WORD}._%+-])[{_WORD}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]*[A-Za-z0-9])++"
#: A group after a space that begins a value of its own is not taken into a phone or card number.
_OTHER = (r"(?!\d{4}[-/]\d{1,2}[-/]\d{1,2}(?!\d)|\d{1,2}[./]\d{1,2}[./]\d{4}(?!\d)|(?:\d{1,3}\.){3}\d|\d{3}-\d{2}-\d{4}(?!\d)"
          r"|\d{3}[-.]\d{3}[-.]\d{4}(?!\d)|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d"
          r"|\d{1,2} (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{4}(?!\d))")
#: Digits of national numbers (least, most) by country code; others are found by groups alone.
PLANS = {
    (8, 8): "45 47 53 65 370 371 386 852 853", (7, 7): "354", (7, 8): "372", (8, 9): "32 36 51 66 213 353 359 381 385 886 966 971 972",
    (9, 9): "27 31 33 34 40 41 48 56 61 93 94 212 233 254 351 380 420 421", (9, 10): "44 81 84 92", (8, 10): "20 60 63 64 82 234",
    (10, 10): "7 30 52 57 58 90 91 880", (10, 11): "54 55 86", (8, 12): "62~", (7, 10): "46~ 95~", (6, 11): "39~ 49~ 352~ 358~", (6, 13): "43~",
}
#: Numbers of open plans have no fixed length: six digits in a row end them, as does a short group after five.
_OPEN = r"(?:[.-]| (?<!\d{6} )(?:(?<!\d{5} )|(?=\d{3}))" + _OTHER + ")"
_CLOSED = r"(?:[.-]| " + _OTHER + ")"


def _plan(codes: list[str], least: int, most: int, sep: str) -> str:
    return (rf"\+(?:{'|'.join(codes)})(?:{sep}?\(?\d(?:\)(?={sep}?\d))?){{{least},{most}}}" + _ENDS) if codes else "(?!)"


NATIONAL = "|".join(
    [r"\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}" + _ENDS, r"\+[2-9]\d{7,14}" + _ENDS]
    + [_plan([c for c in codes.split() if "~" not in c], *size, _CLOSED) for size, codes in PLANS.items()]
    + [_plan([c[:-1] for c in codes.split() if "~" in c], *size, _OPEN) for size, codes in PLANS.items() if "~" in codes])


def _grouped(repeat: str) -> str:
    return r"\+[2-9]\d{0,2}(?:" + _OPEN + r"(?:\(\d{2,4}\)|\d{2,8}))" + repeat + _ENDS


_NOT_AFTER = r"(?<![\p{L}\p{N}+])"
LOCAL = r"(?:\(\d{3}\) ?\d{3}-\d{4}|\d{3}(?<sep>[-.])\d{3}\k<sep>\d{4})" + _ENDS
PHONE = _NOT_AFTER + f"(?:{NATIONAL}|{_grouped('{1,5}')}|{LOCAL})"
IP = r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)"
SSN = _ALONE + r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)"
#: English month names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December")
_MONTH = "(?:" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ")"
NAMED_DATE = _ALONE + rf"(?:\d{{1,2}} {_MONTH} \d{{4}}|{_MONTH} \d{{1,2}}, \d{{4}})" + _ENDS
DATE = _ALONE + r"(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})" + _ENDS
#: Lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _country(n: int, codes: str) -> str:
    groups, last = divmod(n - 4, 4)
    spaced = rf"(?: [A-Z0-9]{{4}}){{{groups}}}" + (rf" [A-Z0-9]{{{last}}}" if last else "")
    return rf"(?:{codes.replace(' ', '|')})\d{{2}}(?:{spaced}|[A-Z0-9]{{{n - 4}}})"


COUNTRY_IBAN = _ALONE + "(?:" + "|".join(_country(n, codes) for n, codes in IBAN_LENGTHS.items()) + ")" + _ENDS
IBAN = _ALONE + r"[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})" + _ENDS
_GAP = "(?:-| " + _OTHER + ")"
#: A year before a card of four groups of four is not its first group.
CARD = (_ALONE + r"(?!(?:19|20)\d{2} \d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?!\d))(?:\d{4}@\d{4}@\d{4}@\d{1,7}|\d{4}@\d{6}@\d{5}|\d{13,19})"
        .replace("@", _GAP) + _ENDS)
_KINDS = (PHONE, IP, DATE, NAMED_DATE, SSN, CARD, COUNTRY_IBAN, IBAN)
CANDIDATE = "|".join(f"(?:{p})" for p in (EMAIL, *_KINDS))

#: Where a candidate may start, for the second look at texts with one that does not validate.
_START = (rf"(?<![{_WORD}])(?=\d|\+\d|\(\d|[A-Z]{{2}}\d{{2}}|{_MONTH} \d)")
#: What may stand at a start, by its first character; the first that validates counts.
_AT_SIGN = (PHONE, *(_NOT_AFTER + _grouped("{%d}" % k) for k in (4, 3, 2, 1)))
_AT_DIGIT = (PHONE, IP, DATE, NAMED_DATE, SSN, CARD, *(_ALONE + p.replace("@", "[ -]") + _ENDS for p in (
    r"\d{4}@\d{4}@\d{4}@\d{4}@\d{1,3}", r"\d{4}@\d{4}@\d{4}@\d{4}", r"\d{4}@\d{6}@\d{4}", r"\d{4}@\d{6}@\d{5}")))
_AT_LETTER = (NAMED_DATE, COUNTRY_IBAN, IBAN, *(
    _ALONE + r"[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){%d}%s" % (k, last) + _ENDS
    for k in (7, 6, 5, 4, 3, 2) for last in (" [A-Z0-9]{1,3}", "")))
#: Pieces and characters that a candidate other than an address may span.
_PIECES, _SPAN = 40, 120
#: What every candidate holds; texts without it are passed by the full search.
MAYBE = r"@|\d{2}|\d\.\d"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chars(s: str) -> str:
    return f"filter(split({s}, ''), q -> q <> '')"


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _round_bits(key: str, tweak: str, i: str, other: str) -> str:
    return f"sha2(concat_ws('|', {_lit(key)}, '{tweak}', cast({i} as string), cast({other} as string)), 256)"


def _numbers(key: str, tweak: str, a: str, b: str, size_a: str, size_b: str) -> str:
    """Feistel over pairs of numbers below ``size_a`` and ``size_b``: ``struct(a, b)``."""
    def moved(half, other, size):
        bits = _round_bits(key, tweak, "i", f"acc.{other}")
        return f"(acc.{half} + cast(conv(substr({bits}, 1, 15), 16, 10) as bigint)) % ({size})"
    return (f"aggregate(sequence(0, {ROUNDS - 1}), "
            f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (acc, i) -> "
            f"if(i % 2 = 0, named_struct('a', {moved('a', 'b', size_a)}, 'b', acc.b), "
            f"named_struct('a', acc.a, 'b', {moved('b', 'a', size_b)})))")


def _string(key: str, tweak: str, s: str) -> str:
    """Feistel over a string's halves: every ASCII digit or letter moves within its class, in its
    place; other characters stay."""
    def moved(half, other):
        def step(base, size):
            by = "cast(conv(substr(bits, 2 * (j % 32) + 1, 2), 16, 10) as int)"
            return f"char({base} + (ascii(c) - {base} + {by}) % {size})"
        shifted = (f"array_join(transform({_chars(f'acc.{half}')}, (c, j) -> case when c rlike '^[0-9]$' then {step(48, 10)} "
                   f"when c rlike '^[a-z]$' then {step(97, 26)} when c rlike '^[A-Z]$' then {step(65, 26)} else c end), '')")
        return _let("bits", _round_bits(key, tweak, "i", f"acc.{other}"), shifted)
    return _let("whole", s, (
        f"aggregate(sequence(0, {ROUNDS - 1}), "
        "named_struct('l', left(whole, cast(length(whole) / 2 as int)), "
        "'r', substr(whole, cast(length(whole) / 2 as int) + 1)), (acc, i) -> "
        f"if(i % 2 = 0, named_struct('l', {moved('l', 'r')}, 'r', acc.r), "
        f"named_struct('l', acc.l, 'r', {moved('r', 'l')})), acc -> concat(acc.l, acc.r))"))


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its letters and digits replaced, in order, by those of ``digits``."""
    return _let("fill", digits, (
        f"aggregate({_chars(shape)}, named_struct('out', '', 'at', 1), (acc, c) -> "
        "if(c rlike '[A-Za-z0-9]', named_struct('out', concat(acc.out, substr(fill, acc.at, 1)), 'at', acc.at + 1), "
        "named_struct('out', concat(acc.out, c), 'at', acc.at)), acc -> acc.out)"))


def _luhn(digits: str) -> str:
    """Luhn sum of the digits, counted from the right."""
    return (f"aggregate(transform(reverse({_chars(digits)}), (c, j) -> if(j % 2 = 0, cast(c as int), "
            "if(c > '4', 2 * cast(c as int) - 9, 2 * cast(c as int)))), 0, (acc, v) -> acc + v)")


def _mod97(s: str) -> str:
    """Remainder of a string of digits and capitals (A is 10) by 97."""
    return (f"aggregate({_chars(s)}, 0, (acc, c) -> if(c rlike '[0-9]', (acc * 10 + cast(c as int)) % 97, "
            "(acc * 100 + ascii(c) - 55) % 97))")


def _email(key, m):
    local = _string(key, "email", f"substring_index({m}, '@', 1)")
    return f"concat({local}, '@', substring_index({m}, '@', -1))"


def _phone(key, m):
    # The country code and, of numbers without one, nothing is kept.
    d = _digits(m)
    code = f"case when {m} like '+1%' then 1 when {m} like '+%' then 2 else 0 end"
    national = f"if({m} like '+%', {d}, concat('1', {d}))"  # one number with or without its +1
    return (f"if(length({d}) between 8 and 15, "
            + _refill(m, f"concat(left({d}, {code}), " + _string(
                key, "phone", f"substr({national}, greatest({code}, 1) + 1)") + ")") + ", null)")


def _ip(key, m):
    part = [f"cast(split({m}, '[.]')[{k}] as int)" for k in range(4)]
    new = _numbers(key, "ip", f"{part[0]} * 256 + {part[1]}", f"{part[2]} * 256 + {part[3]}", "65536", "65536")
    return (f"if(greatest({', '.join(part)}) < 256, " + _let(
        "v", new, "concat_ws('.', v.a div 256, v.a % 256, v.b div 256, v.b % 256)") + ", null)")


def _ssn(key, m):
    # 898 areas (1 to 899 without 666) of 99 groups, 9999 serial numbers
    area, group, serial = f"cast(left({m}, 3) as int)", f"cast(substr({m}, 5, 2) as int)", f"cast(right({m}, 4) as int)"
    new = _numbers(key, "ssn", f"({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1", f"{serial} - 1", "898 * 99", "9999")
    return (f"if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, " + _let(
        "v", new, "concat_ws('-', lpad(cast(v.a div 99 + if(v.a div 99 >= 665, 2, 1) as string), 3, '0'), "
        "lpad(cast(v.a % 99 + 1 as string), 2, '0'), lpad(cast(v.b + 1 as string), 4, '0'))") + ", null)")


def _date(key, m):
    # Formats: year first, day first with dots, month first with slashes (day first if the month says so).
    part = [f"cast(split({m}, '[-./]')[{k}] as int)" for k in range(3)]
    shape = (f"case when {m} rlike '^[0-9]{{4}}' then 'ymd' when {m} like '%.%' then 'dmy' "
             f"when {part[0]} > 12 then 'dmy' else 'mdy' end")
    day = (f"case {shape} when 'ymd' then try_make_timestamp({part[0]}, {part[1]}, {part[2]}, 0, 0, 0) "
           f"when 'dmy' then try_make_timestamp({part[2]}, {part[1]}, {part[0]}, 0, 0, 0) "
           f"else try_make_timestamp({part[2]}, {part[0]}, {part[1]}, 0, 0, 0) end")
    sep = f"regexp_extract({m}, '[-./]', 0)"
    written = lambda at: (
               f"date_format({at}, case {shape} "
               f"when 'ymd' then concat('yyyy', {sep}, 'MM', {sep}, 'dd') "
               f"when 'dmy' then concat('dd', {sep}, 'MM', {sep}, 'yyyy') "
               f"else concat('MM', {sep}, 'dd', {sep}, 'yyyy') end)")
    return _moved_day(key, f"cast({day} as date)", written)


def _named_date(key, m):
    # Day and month name, either first; names are short or whole.
    named = f"regexp_extract({m}, '[A-Za-z]+', 0)"
    month = f"if(length({named}) > 3, 'MMMM', 'MMM')"
    shape = f"if({m} rlike '^[0-9]', concat('d ', {month}, ' yyyy'), concat({month}, ' d, yyyy'))"
    return _moved_day(key, f"cast(try_to_timestamp({m}, {shape}) as date)", lambda at: f"date_format({at}, {shape})")


def _moved_day(key, day, written):
    """SQL of the day's pseudonym as ``written`` writes it; null if ``day`` is."""
    # A span of 100 years from 1930, 2030, ... has 36525 = 75 * 487 days with a leap century, else 36524 = 92 * 397.
    first = "make_date(1930 + 100 * cast(floor((year(day) - 1930) / 100) as int), 1, 1)"
    size_a = "if(datediff(add_months(first, 1200), first) = 36525, 75, 92)"
    size_b = "if(datediff(add_months(first, 1200), first) = 36525, 487, 397)"
    at = "datediff(day, first)"
    new = _numbers(key, "date", f"{at} div ({size_b})", f"{at} % ({size_b})", size_a, size_b)
    body = _let("first", first, _let("v", new, written(f"date_add(first, cast(v.a * ({size_b}) + v.b as int))")))
    return _let("day", day, f"if(day is not null and year(day) between 130 and 9829, {body}, null)")


def _card(key, m):
    # The first digit (the kind of issuer) stays; the check digit is made right.
    moved = f"concat(left(d, 1), {_string(key, 'card', 'substr(d, 2, length(d) - 2)')})"
    with_zero = "concat(body, '0')"
    checked = _let("body", moved, f"concat(body, cast((10 - {_luhn(with_zero)} % 10) % 10 as string))")
    return _let("d", _digits(m), f"if(length(d) between 13 and 19 and {_luhn('d')} % 10 = 0 and d rlike '[1-9]', "
                + _refill(m, checked) + ", null)")


def _iban(key, m):
    # The country stays; the check digits are made right.
    moved = _string(key, "iban", "substr(d, 5)")
    checked = _let("body", moved, "concat(left(d, 2), lpad(cast(98 - "
                   + _mod97("concat(body, left(d, 2), '00')") + " as string), 2, '0'), body)")
    return _let("d", f"replace({m}, ' ', '')", f"if(length(d) between 15 and 34 and "
                + _mod97("concat(substr(d, 5), left(d, 4))") + " = 1, " + _refill(m, checked) + ", null)")


def pseudonym_sql(key: str, m: str = "m") -> str:
    """SQL over a candidate string: its pseudonym, or null if it does not validate."""
    return (f"case when {m} like '%@%' then {_email(key, m)} "
            f"when {m} rlike {_lit('^([0-9]{1,3}[.]){3}[0-9]{1,3}$')} then {_ip(key, m)} "
            f"when {m} rlike {_lit('^([0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$')} then {_date(key, m)} "
            f"when {m} rlike {_lit('^([0-9]{1,2} [A-Z][a-z]+|[A-Z][a-z]+ [0-9]{1,2},) [0-9]{4}$')} then {_named_date(key, m)} "
            f"when {m} rlike {_lit('^[0-9]{3}-[0-9]{2}-[0-9]{4}$')} then {_ssn(key, m)} "
            f"when {m} rlike {_lit('^[+(]|^[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}$')} then {_phone(key, m)} "
            f"when {m} rlike '^[A-Z]' then {_iban(key, m)} else {_card(key, m)} end")


def _second_look(key: str, text: str) -> str:
    """SQL of ``struct(text, n)``: ``text`` with pseudonyms and their number, where every place that a
    candidate may start at is tried, in order, with every length that it may have there.

    Each line is cut around its addresses, and what is between them into pieces at those places.
    """
    def options(patterns):
        return "array(" + ", ".join(f"regexp_extract(w, {_lit('(?s)^.(' + p + ')')}, 1)" for p in patterns) + ")"

    tried = (f"case when substr(w, 2, 1) rlike '[0-9]' then {options(_AT_DIGIT)} "
             f"when substr(w, 2, 1) rlike '[+(]' then {options(_AT_SIGN)} "
             f"when substr(w, 2, 1) rlike '[A-Z]' then {options(_AT_LETTER)} else array('') end")
    valid = (f"try_element_at(filter(transform(filter({tried}, o -> o <> ''), m -> "
             f"named_struct('size', length(m), 'new', {pseudonym_sql(key)})), s -> s.new is not null), 1)")
    window = (f"concat(if(i = 0, if(at = 0, '\\n', 'x'), right(pieces[i - 1], 1)), "
              f"left(array_join(slice(pieces, i + 1, {_PIECES}), ''), {_SPAN}))")
    found = f"transform(pieces, (piece, i) -> named_struct('piece', piece, 'hit', {_let('w', window, valid)}))"
    step = ("case when acc.skip > 0 then named_struct('skip', greatest(acc.skip - length(f.piece), 0), 'n', acc.n, "
            "'out', concat(acc.out, array(substr(f.piece, acc.skip + 1)))) "
            "when f.hit is not null then named_struct('skip', greatest(f.hit.size - length(f.piece), 0), 'n', acc.n + 1, "
            "'out', concat(acc.out, array(f.hit.new, substr(f.piece, f.hit.size + 1)))) "
            "else named_struct('skip', 0, 'n', acc.n, 'out', concat(acc.out, array(f.piece))) end")
    gap = _let("pieces", f"split(gap, {_lit(_START)}, -1)", (
        f"aggregate({found}, named_struct('skip', 0, 'n', 0, 'out', cast(array() as array<string>)), (acc, f) -> {step}, "
        "acc -> named_struct('text', array_join(acc.out, ''), 'n', acc.n))"))
    between = f"transform(split(line, {_lit(EMAIL)}, -1), (gap, at) -> {gap})"
    address = (f"transform(regexp_extract_all(line, {_lit(EMAIL)}, 0), m -> "
               f"named_struct('text', {_email(key, 'm')}, 'n', 1))")
    woven = f"flatten(zip_with({between}, {address}, (g, e) -> array(g, coalesce(e, named_struct('text', '', 'n', 0)))))"
    lines = f"flatten(transform(split({text}, '(?<=\\n)', -1), line -> {woven}))"
    return _let("parts", lines, ("named_struct('text', array_join(transform(parts, x -> x.text), ''), "
                                 "'n', aggregate(parts, 0, (acc, x) -> acc + x.n))"))


def with_pseudonyms(docs: DataFrame, key: str, text: str = "text", found: str = "n_found") -> DataFrame:
    """``docs`` with valid personal values in column ``text`` replaced by pseudonyms, and ``found``,
    the number of replacements, appended (a column of that name is replaced).

    Null text stays null with 0 found; empty text stays empty. Every occurrence in a text of any
    length is replaced; all else is kept to the byte.
    """
    names = [c for c in docs.columns if c != found]
    whole = F.col(text).cast("string")
    rest = [c for c in names if c != text]
    # The working columns live in one struct, so no column of docs can clash with them.
    out = (docs.select(F.struct(*[F.col(c) for c in rest]).alias("row") if rest else F.lit(None).alias("row"),
                       whole.alias("text"))
           .withColumn("m", F.when(F.col("text").rlike(MAYBE), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))))
    out = out.withColumn("r", F.when(F.size("m") > 0, F.expr(f"transform(m, m -> {pseudonym_sql(key)})")))
    gaps = F.split("text", CANDIDATE, -1)
    joined = F.array_join(F.flatten(F.zip_with(gaps, "r", lambda g, k: F.array(g, F.coalesce(k, F.lit(""))))), "")
    out = out.withColumn("s", F.when(F.exists("r", lambda r: r.isNull()), F.expr(_second_look(key, "text")))
                         .when(F.col("r").isNotNull(), F.struct(joined.alias("text"), F.size("r").alias("n"))))
    changed = F.coalesce(F.col("s.text"), F.col("text"))
    return out.select(*[changed.alias(c) if c == text else F.col("row")[c].alias(c) for c in names],
                      F.coalesce(F.col("s.n"), F.lit(0)).cast("int").alias(found))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_found``, ``text`` with pseudonyms.

    Repeated rows and null ids keep their rows; an empty table gives no row.
    """
    return with_pseudonyms(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), key).select(
        "doc_id", "n_found", "text")
