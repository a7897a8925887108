"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses.

Native: DataFrame expressions only, no shuffle. Each match is validated and then permuted within its
own format by a keyed Feistel network, so a value becomes the same valid-looking value wherever it
occurs, in any document and with any separators, and ``inverse=True`` with the key gives it back.

| kind | validated by | permuted |
| --- | --- | --- |
| card numbers, 13-19 digits, plain or in groups | Luhn | all digits but the last, which is the new check digit |
| IBAN | length of its country, ISO 7064 mod 97 | the digits of the account; the check digits are computed anew |
| SSN (ddd-dd-dddd) | area, group and serial in use | within the numbers in use |
| telephone numbers with country code, (ddd) ddd-dddd or ddd-ddd-dddd | 8-15 digits | all digits but the country code and a (0) after it; a first digit 0 stays, others don't become 0 |
| IPv4 addresses | four bytes | all four |
| dates, ISO or day and month first with . or / | calendar, 1800-2199 | the day number |
| e-mail addresses | shape | letters and digits of the local part, each within its class |

The network alternates x += F(y) mod A and y += F(x) mod B over the two parts of a value; F is
SHA-256 of key, kind, round and the other part. IBANs are looked for first, at every place where one may
begin; what fails as an IBAN is searched for the other kinds. Country codes are those of E.164, whatever
the separators; numbers of plans with a fixed length end there. Digits may be grouped by plain,
no-break, thin and narrow no-break spaces. Not looked for: numbers with 00 for the plus, dates with the year
first and slashes, cards grouped by dots, IBANs with hyphens or small letters. Numbers that fail validation stay as they are, and so
does everything around a match. Defined results: a null text stays null and has 0 matches, other rows
pass through with all their columns (a column ``n_found`` is replaced). Every row is treated on its
own, so repeated rows and ids make no difference. Separators and the widths of date fields are kept
(a one-digit day may become two digits). A date with ``/`` counts as month first unless only day first
is valid; where a date is valid in one order only, its pseudonym may be valid in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10
#: Blanks that group digits: the plain one, and no-break, thin and narrow no-break spaces.
GAP = " \u00a0\u2009\u202f"
DAYS = (189, 773)  # 400 years have 146,097 = 189 * 773 days
#: Lengths of the IBAN registry, and of countries that use IBANs without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    lengths = [
        f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:[{GAP}]?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"[{GAP}]?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, codes in IBAN_LENGTHS.items()
    ]
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:[{GAP}]?[A-Z0-9]{{4}}){{2,7}}(?:[{GAP}]?[A-Z0-9]{{1,3}})?"
    # not in the local part of an e-mail address
    return rf"(?:{'|'.join([*lengths, other])})(?![A-Za-z0-9]|[A-Za-z0-9._%+-]{{0,64}}@)"


#: Calling codes of E.164; all that are not listed have three digits.
CALLING = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Digits after the calling code, in plans where all numbers have as many.
PLANS = {"1|7|30|91": 10, "31|33|34|41|48|61|351|420": 9, "45|47": 8}
_MARK, _BETWEEN = f"[{GAP}.-]", f"[{GAP}-]"
_DIGIT = rf"(?:{_MARK}?\(?[0-9]\)?)"
_TRUNK = rf"(?:{_MARK}?\(0\))?"
IBAN = _iban_pattern()
IBAN_STARTS = rf"(?<![A-Za-z0-9])(?={IBAN})"
PATTERN = "|".join([
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4})(?![0-9])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    *(rf"(?<![0-9+])\+(?:{codes}){_TRUNK}{_DIGIT}{{{n}}}(?![0-9])" for codes, n in PLANS.items()),
    rf"(?<![0-9+])\+{CALLING}{_TRUNK}{_DIGIT}{{5,14}}(?![0-9])",
    rf"(?<![0-9+])(?:1{_MARK}?)?\([0-9]{{2,4}}\){_MARK}?[0-9]{{3}}{_MARK}?[0-9]{{4}}(?![0-9])",
    rf"(?<![0-9+.-])(?:1{_MARK})?[0-9]{{3}}({_MARK})[0-9]{{3}}\2[0-9]{{4}}(?![0-9]|[.-][0-9])",
    rf"(?<![0-9.-])(?:[0-9]{{13,19}}|[0-9]{{4}}({_BETWEEN})[0-9]{{4}}\3[0-9]{{4}}\3[0-9]{{1,7}}|[0-9]{{4}}({_BETWEEN})[0-9]{{6}}\4[0-9]{{5}})(?![0-9])",
])


def _chars(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)(.)"), F.lit(1))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _long(s: Column) -> Column:
    return F.when(s == "", F.lit(0)).otherwise(s).cast("bigint")


def _feistel(x: Column, y: Column, a: Column, b: Column, kind: str, key: str, inverse: bool) -> Column:
    """Struct (x, y) permuted within Z_a x Z_b."""
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        other, own, size = F.when(even, s["y"]).otherwise(s["x"]), F.when(even, s["x"]).otherwise(s["y"]), F.when(even, a).otherwise(b)
        digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), r.cast("string"), other.cast("string")), 256)
        move = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), size)
        new = F.pmod(own - move if inverse else own + move, size)
        return F.struct(F.when(even, new).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise(new).alias("y"))

    return F.aggregate(steps, F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y")), step)


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _permuted_digits(d: Column, kind: str, key: str, inverse: bool) -> Column:
    n = F.length(d)
    left = F.ceil(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
    moved = _feistel(
        _long(F.substr(d, F.lit(1), left)), _long(F.substr(d, left + 1)), power(left), power(n - left),
        kind, key, inverse,
    )
    return _with(moved, lambda s: F.concat(F.lpad(s["x"].cast("string"), left, F.lit("0")), F.when(n > left, F.lpad(s["y"].cast("string"), n - left, F.lit("0"))).otherwise("")))


def _put_digits(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    walk = F.aggregate(
        _chars(shape), start,
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substr(digits, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))),
    )
    return walk["out"]


def _luhn(d: Column) -> Column:
    n = F.length(d)

    def add(s: Column, i: Column) -> Column:
        v = F.substr(d, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return s + F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str, inverse: bool) -> Column:
    def new(d: Column) -> Column:
        payload = _permuted_digits(F.substr(d, F.lit(1), F.length(d) - 1), "card", key, inverse)
        return _with(payload, lambda p: _put_digits(m, F.concat(p, F.pmod(10 - _luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string"))))

    return _with(_digits(m), lambda d: F.when(_luhn(d) % 10 == 0, new(d)).otherwise(m))


def _mod97(s: Column) -> Column:
    return F.aggregate(
        _chars(s), F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(m: Column, key: str, inverse: bool) -> Column:
    plain = F.regexp_replace(m, f"[{GAP}]", "")

    def new(p: Column) -> Column:
        country, account = F.substr(p, F.lit(1), F.lit(2)), F.substr(p, F.lit(5))
        moved = _put_digits(account, _permuted_digits(_digits(account), "iban", key, inverse))
        check = lambda a: F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
        return _with(moved, lambda a: _put_digits(m, F.concat(check(a), _digits(a))))

    return _with(plain, new)


def _is_iban(m: Column) -> Column:
    return _with(F.regexp_replace(m, f"[{GAP}]", ""), lambda p: _mod97(F.concat(F.substr(p, F.lit(5)), F.substr(p, F.lit(1), F.lit(4)))) == 1)


def _around_ibans(text: Column) -> Column:
    """The text as structs (gap, iban): valid IBANs and what stands before each; the last has no IBAN.

    Places where an IBAN may begin are all looked at, unless they lie in a valid one.
    """
    pieces, found = F.split(text, IBAN_STARTS, -1), F.regexp_extract_all(text, F.lit(IBAN_STARTS.replace("(?=", "(?=(", 1) + ")"), F.lit(1))
    part = "struct<gap:string,iban:string>"
    # a piece begins with its candidate, only the first may have none
    pairs = F.zip_with(pieces, F.when(F.size(pieces) > F.size(found), F.concat(F.array(F.lit("")), found)).otherwise(found), lambda p, c: F.struct(p.alias("p"), c.alias("c")))
    start = F.struct(F.array().cast(f"array<{part}>").alias("out"), F.lit("").alias("gap"), F.lit(0).alias("skip"))

    def step(s: Column, x: Column) -> Column:
        def over(out: Column, gap: Column, skip: Column) -> Column:
            return F.struct(out.alias("out"), F.concat(gap, F.substr(x["p"], skip + 1)).alias("gap"), F.greatest(F.lit(0), skip - F.length(x["p"])).alias("skip"))

        taken = (s["skip"] == 0) & (x["c"] != "") & _is_iban(x["c"])
        one = F.struct(s["gap"].alias("gap"), x["c"].alias("iban")).cast(part)
        return F.when(taken, over(F.concat(s["out"], F.array(one)), F.lit(""), F.length(x["c"]))).otherwise(over(s["out"], s["gap"], s["skip"]))

    return F.aggregate(pairs, start, step, lambda s: F.concat(s["out"], F.array(F.struct(s["gap"].alias("gap"), F.lit(None).cast("string").alias("iban")).cast(part))))


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    area, group, serial = (F.substring(m, *at).cast("bigint") for at in ((1, 3), (5, 2), (8, 4)))
    ok = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # 898 areas in use, 99 groups of 9,999 serials
    moved = _feistel(area - 1 - (area > 666).cast("bigint"), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), "ssn", key, inverse)
    shown = lambda s: F.format_string(
        "%03d-%02d-%04d", s["x"] + 1 + (s["x"] >= 665).cast("bigint"), F.floor(s["y"] / 9999) + 1, s["y"] % 9999 + 1
    )
    return F.when(ok, _with(moved, shown)).otherwise(m)


def _phone(m: Column, key: str, inverse: bool) -> Column:
    code = F.regexp_extract(m, rf"^(?:\+{CALLING}{_TRUNK}|1{_MARK}?(?=\()|1{_MARK})", 0)
    rest = F.substr(m, F.length(code) + 1)

    def new(d: Column) -> Column:
        n = F.length(d)
        left = F.ceil(n / 2).cast("int")
        power = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
        # a first digit 0 stays, so that none but the (0) of a code is read as one
        low = F.when(F.substr(d, F.lit(1), F.lit(1)) == "0", F.lit(0)).otherwise(power(left - 1)).cast("bigint")
        size = F.when(low == 0, power(left - 1)).otherwise(9 * power(left - 1))
        moved = _feistel(_long(F.substr(d, F.lit(1), left)) - low, _long(F.substr(d, left + 1)), size, power(n - left), "phone", key, inverse)
        return _with(moved, lambda s: F.concat(F.lpad((s["x"] + low).cast("string"), left, F.lit("0")), F.lpad(s["y"].cast("string"), n - left, F.lit("0"))))

    count = F.length(_digits(m))
    return F.when(count.between(8, 15), F.concat(code, _put_digits(rest, _with(_digits(rest), new)))).otherwise(m)


def _ip(m: Column, key: str, inverse: bool) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))

    def new(p: Column) -> Column:
        moved = _feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), "ip", key, inverse)
        return _with(moved, lambda s: F.format_string("%d.%d.%d.%d", F.floor(s["x"] / 256), s["x"] % 256, F.floor(s["y"] / 256), s["y"] % 256))

    return _with(part, lambda p: F.when(F.forall(p, lambda x: x < 256), new(p)).otherwise(m))


def _date(m: Column, key: str, inverse: bool) -> Column:
    part = F.split(m, "[./-]")
    iso = m.contains("-")
    day_first = F.concat_ws("-", part[2], F.lpad(part[1], 2, "0"), F.lpad(part[0], 2, "0"))
    month_first = F.concat_ws("-", part[2], F.lpad(part[0], 2, "0"), F.lpad(part[1], 2, "0"))
    on = lambda s: F.try_to_date(s, "yyyy-MM-dd")
    slash = m.contains("/")
    as_month = slash & on(month_first).isNotNull() | ~slash & on(day_first).isNull()
    day = F.when(iso, on(m)).when(as_month, on(month_first)).otherwise(on(day_first))

    def new(number: Column) -> Column:
        moved = _feistel(F.floor(number / DAYS[1]), number % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), "date", key, inverse)
        to = F.date_add(F.lit("1800-01-01").cast("date"), (moved["x"] * DAYS[1] + moved["y"]).cast("int"))

        def shown(d: Column) -> Column:
            wide = lambda v, like: F.when(F.length(like) == 2, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
            mark, year = F.substr(m, F.length(part[0]) + 1, F.lit(1)), F.year(d).cast("string")
            first = F.when(as_month, wide(F.month(d), part[0])).otherwise(wide(F.day(d), part[0]))
            second = F.when(as_month, wide(F.day(d), part[1])).otherwise(wide(F.month(d), part[1]))
            return F.when(iso, d.cast("string")).otherwise(F.concat(first, mark, second, mark, year))

        return _with(to, shown)

    number = F.datediff(day, F.lit("1800-01-01").cast("date"))
    return _with(number, lambda n: F.when(n.between(0, DAYS[0] * DAYS[1] - 1), new(n.cast("bigint"))).otherwise(m))


def _email(m: Column, key: str, inverse: bool) -> Column:
    """Feistel over the halves of the local part: each character moves within its class."""
    at = F.instr(m, "@")
    local = F.substr(m, F.lit(1), at - 1)
    left = F.ceil((at - 1) / 2).cast("int")
    steps = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def shift(s: Column, stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = F.conv(F.substr(stream, 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int") * (-1 if inverse else 1)
            move = lambda base, n: F.char(F.lit(base) + F.pmod(F.ascii(c) - base + by, F.lit(n)))
            return F.when(c.rlike("[a-z]"), move(97, 26)).when(c.rlike("[A-Z]"), move(65, 26)).when(c.rlike("[0-9]"), move(48, 10)).otherwise(c)

        return F.array_join(F.transform(_chars(s), one), "")

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        other = F.when(even, s["y"]).otherwise(s["x"])
        stream = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), r.cast("string"), F.length(other).cast("string"), other), 256)
        new = shift(F.when(even, s["x"]).otherwise(s["y"]), stream)
        return _with(new, lambda v: F.struct(F.when(even, v).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise(v).alias("y")))

    moved = F.aggregate(steps, F.struct(F.substr(local, F.lit(1), left).alias("x"), F.substr(local, left + 1).alias("y")), step)
    return _with(moved, lambda s: F.concat(s["x"], s["y"], F.substr(m, at)))


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one match of PATTERN; the match itself where validation fails."""
    return (
        F.when(m.contains("@"), _email(m, key, inverse))
        .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), _ip(m, key, inverse))
        .when(m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\2[0-9]{4})$"), _date(m, key, inverse))
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), _ssn(m, key, inverse))
        .when(m.rlike(rf"^[+(]|^1{_MARK}?\(|^(?:1{_MARK})?[0-9]{{3}}({_MARK})[0-9]{{3}}\1[0-9]{{4}}$"), _phone(m, key, inverse))
        .otherwise(_card(m, key, inverse))
    )


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """The rows with text pseudonymised and n_found, the values that were replaced."""
    text = F.col("text").cast("string")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_found")]
    # most texts have no digit and no @, so they never reach the long patterns
    part = "array<struct<gap:string,iban:string>>"
    whole = F.array(F.struct(text.alias("gap"), F.lit(None).cast("string").alias("iban"))).cast(part)
    parts = F.when(text.rlike(r"[A-Z]{2}[0-9]{2}"), _around_ibans(text)).when(text.rlike("[0-9@]"), whole).otherwise(F.array().cast(part))
    split = docs.select(*rest, text.alias("text"), parts.alias("_parts"))
    split = split.withColumn("_found", F.transform("_parts", lambda p: F.regexp_extract_all(p["gap"], F.lit(PATTERN), F.lit(0))))
    changed = split.withColumn("_new", F.transform("_found", lambda found: F.transform(found, lambda m: pseudonym(m, key, inverse))))
    changed = changed.withColumn("_ibans", F.transform("_parts", lambda p: F.when(p["iban"].isNotNull(), _iban(p["iban"], key, inverse))))
    gaps = F.zip_with("_parts", "_new", lambda p, new: F.array_join(F.zip_with(F.split(p["gap"], PATTERN, -1), new, lambda gap, n: F.concat(gap, F.coalesce(n, F.lit("")))), ""))
    joined = F.array_join(F.zip_with(gaps, "_ibans", lambda gap, iban: F.concat(gap, F.coalesce(iban, F.lit("")))), "")
    count = lambda pairs: F.size(F.filter(pairs, lambda x: x))
    replaced = count(F.zip_with(F.flatten("_found"), F.flatten("_new"), lambda a, b: a != b)) + count(F.zip_with("_parts", "_ibans", lambda p, new: p["iban"] != new))
    return changed.select(
        *rest, F.when(F.size("_parts") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.when(F.size("_parts") > 0, replaced).otherwise(F.lit(0)).cast("bigint").alias("n_found"),
    )
