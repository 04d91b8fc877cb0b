"""Personal data: validated numbers and dates replaced by keyed pseudonyms of the same format."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import text_of

#: Rounds of the Feistel network.
ROUNDS = 10
#: The key of the registered query; a real one is a secret of the caller.
EXAMPLE_KEY = "example key, to be replaced"

# The formats in which personal data are looked for.  What a pattern can check is
# checked in it, so that a candidate that fails does not consume its text.
_LOCAL = r"[A-Za-z0-9._%+-]"
# A domain has labels of at most 63 letters, 127 of them: repeats of groups are bounded
# everywhere, because the matcher descends once for each and would run out of stack.
_DOMAIN = r"@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,}"
EMAIL = rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_DOMAIN}"
#: An address at the end of a longer run, and what tells that a text may have one.
LATE_EMAIL, LONG_RUN = rf"(?<={_LOCAL}){_LOCAL}{{64}}{_DOMAIN}", rf"(?<!{_LOCAL}){_LOCAL}{{65,}}+@"
#: What may begin with an account, as group 1, at each place where one may begin.
ACCOUNT_RUN = (
    r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?[A-Za-z0-9]*))"
)
#: Lengths of accounts by country; where a country is not listed the longest valid one counts.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_YEAR = r"(?:18|19|20|21)[0-9]{2}"
_LEAP = r"(?:(?:18|19|20|21)(?:0[48]|[2468][048]|[13579][26])|2000)"
#: Days and months of every year, without the 29th of February.
_MONTH_DAYS = [
    (r"(?:0[13578]|1[02])", r"(?:0[1-9]|[12][0-9]|3[01])"), (r"(?:0[469]|11)", r"(?:0[1-9]|[12][0-9]|30)"),
    ("02", r"(?:0[1-9]|1[0-9]|2[0-8])"),
]
ISO_DATE = (
    r"(?<![0-9./-])(?=[0-9]{4}-)(?:" + _YEAR + "-(?:" + "|".join(f"{m}-{d}" for m, d in _MONTH_DAYS)
    + rf")|{_LEAP}-02-29)(?![0-9])"
)


def _day_dates(mark: str) -> str:
    pairs = [x for m, d in _MONTH_DAYS for x in (d + mark + m, m + mark + d)]
    return f"(?:{'|'.join(pairs)}){mark}{_YEAR}|(?:29{mark}02|02{mark}29){mark}{_LEAP}"


DAY_DATE = (
    r"(?<![0-9./-])(?=[0-9]{2}[./-][0-9]{2}[./-])(?:"
    + "|".join(map(_day_dates, ("/", r"\.", "-"))) + r")(?![0-9])"
)
SOCIAL = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
ADDRESS = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
#: What may be a card, as group 1, at each place where one may begin.
CARD_RUN = (
    r"(?<![0-9])(?=((?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])))"
)
#: Countries whose numbers have one length, by the digits after the country code.
PHONE_LENGTHS = {8: "45|47|65|852", 9: "27|31|33|34|41|48|61|84|351|380|420|421", 10: "7|30|44|52|63|90|91", 11: "86"}


def phone_pattern(after: str) -> str:
    """Phone numbers, which no gap carries on into ``after``.

    A number ends at the length its country fixes, or at a gap behind six digits in a row, so
    it is the same whatever number stands behind it; where neither gives one, at most 15 digits.
    """
    gap = rf"[ .()-]{{1,2}}(?!{after})"
    digit = rf"(?:(?:{gap})?[0-9])"
    block = rf"(?:(?:[.()-]{{0,2}}|(?<![0-9]{{6}}){gap})[0-9])"
    fixed = "|".join(
        rf"\+(?:{codes})(?:[ .-]?\(0\))?{digit}{{{n}}}(?![0-9])" for n, codes in PHONE_LENGTHS.items()
    )
    return (
        r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
        rf"|{fixed}|\+[2-9]{block}{{7,14}}(?![0-9])|\+[2-9]{digit}{{7,14}}(?![0-9])"
        r"|(?<![0-9])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-]"
        rf"(?!{after})[0-9]{{4}}(?![0-9])"
    )


_NUMBERS = "|".join((ISO_DATE, DAY_DATE, SOCIAL, ADDRESS))
#: What ends a phone number at a gap; what its own groups may look like does so only behind a
#: country code and eight digits, eleven signs with the gaps.
_BEHIND = r"(?<=\+[0-9 .()-]{11,40})"
_STOPS = f"{ISO_DATE}|{_BEHIND}(?:{DAY_DATE}|{SOCIAL}|{ADDRESS})"
#: Candidates of a text without valid accounts and cards.
CANDIDATE = "|".join((EMAIL, _NUMBERS, phone_pattern(_STOPS)))
KINDS = ["email", "account", "date", "social", "address", "phone", "card"]

#: Dates are permuted within the 400 years from here: 146,097 days, 189 times 773.
FIRST_DAY, FIRST_YEAR, DAYS_HIGH, DAYS_LOW = "1800-01-01", 1800, 189, 773
#: Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999.
AREAS, GROUPS, SERIALS = 898, 99, 9999

_long = lambda c: c.cast("bigint")


def _noise(key: str, tweak: str, turn: Column, other: Column) -> Column:
    """Sixty keyed bits of a round and the half that stays."""
    said = F.concat_ws("|", F.lit(key), F.lit(tweak), turn, other)
    return _long(F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 15), 16, 10))


def permuted(high: Column, low: Column, highs: Column, lows: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the pairs below (``highs``, ``lows``), as a struct.

    Each round adds noise of one part to the other, modulo its size, so the network is
    one-to-one on exactly these pairs, whatever the sizes; nothing has to be walked.
    """

    def step(pair, turn):
        even = turn % 2 == 0
        moved = F.when(
            even, (pair["h"] + _noise(key, tweak, turn, pair["l"]) % highs) % highs
        ).otherwise((pair["l"] + _noise(key, tweak, turn, pair["h"]) % lows) % lows)
        return F.struct(
            F.when(even, moved).otherwise(pair["h"]).alias("h"),
            F.when(even, pair["l"]).otherwise(moved).alias("l"),
        )

    start = F.struct(_long(high).alias("h"), _long(low).alias("l"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _then(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _padded(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _power(n: Column) -> Column:
    return _long(F.pow(F.lit(10.0), n))


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the strings of two to thirty digits of one length."""

    def cut(d):
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        rest = n - half
        pair = permuted(
            F.left(d, half), F.right(d, rest), _power(half), _power(rest), key, tweak
        )
        return _then(pair, lambda p: F.concat(_padded(p["h"], half), _padded(p["l"], rest)))

    return _then(digits, cut)


def _refilled(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in order; separators and letters stay."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: F.when(
                F.substring(text, i, F.lit(1)).between("0", "9"),
                F.substring(digits, F.length(_digits(F.left(text, i))), F.lit(1)),
            ).otherwise(F.substring(text, i, F.lit(1))),
        ),
        "",
    )


def _check_digit(payload: Column) -> Column:
    """The last digit that makes a number pass the Luhn check."""
    n = F.length(payload)

    def step(total, i):
        value = F.substring(payload, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.floor(value / 10).cast("int") + value % 10

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)
    return ((10 - total % 10) % 10).cast("string")


def _card(m: Column, key: str) -> Column:
    def number(d):
        payload = permuted_digits(F.left(d, F.length(d) - 1), key, "card")
        return F.when(
            F.call_function("luhn_check", d), _then(payload, lambda p: _refilled(m, F.concat(p, _check_digit(p))))
        )

    return _then(_digits(m), number)


def _mod97(text: Column) -> Column:
    def step(left, i):
        letter = F.substring(text, i, F.lit(1))
        return F.when(letter.between("0", "9"), (left * 10 + F.ascii(letter) - 48) % 97).otherwise(
            (left * 100 + F.ascii(letter) - 55) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), step)


def _account(m: Column, key: str) -> Column:
    """Country and letters stay, digits are permuted, the check digits are made anew."""

    def number(a):
        country, own = F.left(a, F.lit(2)), F.substring(a, F.lit(5), F.length(a))
        moved = F.concat(F.lit("00"), permuted_digits(_digits(own), key, "account"))
        fresh = _then(
            moved,
            lambda d: _then(
                _refilled(F.concat(F.lit("00"), own), d), lambda x: F.substring(x, F.lit(3), F.length(x))
            ),
        )
        whole = _then(
            fresh,
            lambda o: F.concat(
                _padded(98 - _mod97(F.concat(o, country, F.lit("00"))), 2), _digits(o)
            ),
        )
        valid = (F.length(a).between(15, 34)) & (F.length(_digits(own)) >= 2) & (
            _mod97(F.concat(own, F.left(a, F.lit(4)))) == 1
        )
        return F.when(valid, _then(whole, lambda w: _refilled(m, w)))

    return _then(F.replace(m, F.lit(" "), F.lit("")), number)


def _number(m: Column, start: int, size: int) -> Column:
    return F.substring(m, start, size).cast("int")


def _date(m: Column, key: str) -> Column:
    """A day of the same 400 years, written in the same order with the same marks."""
    iso = m.rlike("^[0-9]{4}")
    first = F.make_date
    days_in = lambda y, mo: F.dayofmonth(F.last_day(first(y, mo, F.lit(1))))
    fits = lambda y, mo, d: F.when(
        y.between(FIRST_YEAR, FIRST_YEAR + 399) & mo.between(1, 12), d.between(1, days_in(y, mo))
    ).otherwise(False)

    def written(y, mo, d, layout):
        day = F.datediff(first(y, mo, d), F.lit(FIRST_DAY).cast("date"))
        pair = permuted(
            F.floor(day / DAYS_LOW), day % DAYS_LOW, F.lit(DAYS_HIGH), F.lit(DAYS_LOW), key, "date"
        )
        return _then(
            pair,
            lambda p: layout(
                F.date_add(
                    F.lit(FIRST_DAY).cast("date"), (p["h"] * DAYS_LOW + p["l"]).cast("int")
                )
            ),
        )

    y, mo, d = _number(m, 1, 4), _number(m, 6, 2), _number(m, 9, 2)
    year, a, b = _number(m, 7, 4), _number(m, 1, 2), _number(m, 4, 2)
    mark = F.substring(m, 3, 1)
    day_first = lambda x: F.concat(F.date_format(x, "dd"), mark, F.date_format(x, "MM"), mark, F.date_format(x, "yyyy"))
    month_first = lambda x: F.concat(F.date_format(x, "MM"), mark, F.date_format(x, "dd"), mark, F.date_format(x, "yyyy"))
    other = F.when(fits(year, b, a), written(year, b, a, day_first)).when(
        fits(year, a, b), written(year, a, b, month_first)
    )
    return F.when(
        iso, F.when(fits(y, mo, d), written(y, mo, d, lambda x: F.date_format(x, "yyyy-MM-dd")))
    ).otherwise(other)


def _social(m: Column, key: str) -> Column:
    area, group, serial = _number(m, 1, 3), _number(m, 5, 2), _number(m, 8, 4)
    high = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permuted(
        high, (group - 1) * SERIALS + serial - 1, F.lit(AREAS), F.lit(GROUPS * SERIALS), key, "social"
    )

    def written(p):
        new = p["h"] + 1
        return F.concat_ws(
            "-", _padded(new + F.when(new >= 666, 1).otherwise(0), 3),
            _padded(F.floor(p["l"] / SERIALS) + 1, 2), _padded(p["l"] % SERIALS + 1, 4),
        )

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, _then(pair, written))


def _address(m: Column, key: str) -> Column:
    def parts(octets):
        o = [octets[i].cast("int") for i in range(4)]
        valid = reduce(lambda x, y: x & y, [v.between(0, 255) for v in o]) & ~m.rlike(r"(^|\.)0[0-9]")
        pair = permuted(
            o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "address"
        )
        return F.when(
            valid,
            _then(
                pair,
                lambda p: F.concat_ws(
                    ".", F.floor(p["h"] / 256), p["h"] % 256, F.floor(p["l"] / 256), p["l"] % 256
                ),
            ),
        )

    return _then(F.split(m, r"\."), parts)


def _phone(m: Column, key: str) -> Column:
    """The country code stays: one digit for +1 and +7, else two."""

    def number(d):
        kept = F.when(~F.startswith(m, F.lit("+")), 0).when(d.rlike("^[17]"), 1).otherwise(2)
        own = F.substring(d, kept + 1, F.length(d))
        return _refilled(m, F.concat(F.left(d, kept), permuted_digits(own, key, "phone")))

    return _then(_digits(m), number)


def _shifted(text: Column, noise: Column) -> Column:
    """Letters and digits turned within their class by the bytes of a digest."""

    def turned(i):
        code = F.ascii(F.substring(text, i, F.lit(1)))
        by = F.conv(F.substring(noise, i * 2 - 1, F.lit(2)), 16, 10).cast("int")
        within = lambda low, n: F.char(F.lit(low) + (code - low + by) % n)
        return (
            F.when(code.between(97, 122), within(97, 26)).when(code.between(65, 90), within(65, 26))
            .when(code.between(48, 57), within(48, 10)).otherwise(F.substring(text, i, F.lit(1)))
        )

    return F.when(F.length(text) == 0, text).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), turned), "")
    )


def _email(m: Column, key: str) -> Column:
    """The part before the sign, letter by letter within its class; the domain stays."""

    def step(pair, turn):
        even = turn % 2 == 0
        other = F.when(even, pair["l"]).otherwise(pair["h"])
        said = F.concat_ws("|", F.lit(key), F.lit("email"), turn, other)
        moved = _shifted(
            F.when(even, pair["h"]).otherwise(pair["l"]), F.sha2(said.cast("binary"), 256)
        )
        return F.struct(
            F.when(even, moved).otherwise(pair["h"]).alias("h"),
            F.when(even, pair["l"]).otherwise(moved).alias("l"),
        )

    def local(own):
        half = F.floor(F.length(own) / 2).cast("int")
        start = F.struct(F.left(own, half).alias("h"), F.right(own, F.length(own) - half).alias("l"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda p: F.concat(p["h"], p["l"])
        )

    at = F.instr(m, "@")
    return F.concat(_then(F.left(m, at - 1), local), F.substring(m, at, F.length(m)))


def _luhn(m: Column) -> Column:
    return F.call_function("luhn_check", _digits(m))


def _account_in(run: Column) -> Column:
    """The valid account a run begins with, or null: of its country's length, else the longest."""
    words = F.split(run, " ")
    starts = F.transform(
        F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    )
    known = F.create_map(*[F.lit(x) for n, codes in ACCOUNT_LENGTHS.items() for c in codes.split() for x in (c, n)])

    def rated(m):
        return _then(
            F.replace(m, F.lit(" "), F.lit("")),
            lambda a: F.when(
                a.rlike("^[A-Z0-9]{15,34}$") & a.rlike("^.{4}.*[0-9].*[0-9]")
                & (_mod97(F.concat(F.substring(a, F.lit(5), F.length(a)), F.left(a, F.lit(4)))) == 1),
                F.struct(
                    F.coalesce(F.try_element_at(known, F.left(a, F.lit(2))) == F.length(a), F.lit(False)).alias("fits"),
                    F.length(a).alias("n"), m.alias("text"),
                ),
            ),
        )

    return F.array_max(F.transform(starts, rated))["text"]


def _any_of(values: Column) -> Column:
    """A pattern for the given texts, the longest first; they have no special signs."""
    sized = F.transform(F.array_distinct(values), lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))
    return F.array_join(F.transform(F.reverse(F.array_sort(sized)), lambda x: x["v"]), "|")


def candidates(body: Column, accounts: Column, cards: Column) -> Column:
    """The pattern of a text's candidates, given its valid accounts and cards.

    Checks no pattern can make are made before, at every place where an account or a card may
    begin, so each candidate is valid and none is hidden by one that is not.
    """
    card = F.concat(F.lit("(?<![0-9])(?=[0-9])(?:"), _any_of(cards), F.lit(")(?![0-9])"))
    account = F.concat(
        F.lit("(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"), _any_of(accounts), F.lit(")(?![A-Za-z0-9])|")
    )
    # Cards are met alone and behind the gaps of phones.
    marked = phone_pattern(f"{_STOPS}|@@").split("@@")
    phone = F.concat(F.lit(marked[0]), *[x for part in marked[1:] for x in (card, F.lit(part))])
    late = F.when(body.rlike(LONG_RUN), F.lit(f"{LATE_EMAIL}|")).otherwise("")
    numbers = F.lit(f"{_NUMBERS}|")
    return F.concat(
        F.lit(f"{EMAIL}|"), late, F.when(F.size(accounts) > 0, account).otherwise(""), numbers,
        F.when(F.size(cards) > 0, F.concat(phone, F.lit("|"), card)).otherwise(F.lit(phone_pattern(_STOPS))),
    )


def pseudonym(found: Column, key: str) -> Column:
    """``kind`` and ``value`` of a candidate; both null where its check fails."""
    whole = lambda pattern: found.rlike(f"^(?:{pattern})$")
    # A card has 13 digits or more and no sign before them, a phone with so many has one.
    phone = F.startswith(found, F.lit("+")) | (F.length(_digits(found)) < 13)
    kinds = [
        ("email", F.instr(found, "@") > 0, _email), ("account", whole("[A-Z]{2}.*"), _account),
        ("date", whole(ISO_DATE) | whole(DAY_DATE), _date), ("social", whole(SOCIAL), _social),
        ("address", whole(ADDRESS), _address), ("phone", phone, _phone),
    ]
    value, kind = None, None
    for name, fits, make in kinds:
        value = F.when(fits, make(found, key)) if value is None else value.when(fits, make(found, key))
        kind = F.when(fits, name) if kind is None else kind.when(fits, name)
    return _then(
        value.otherwise(_card(found, key)),
        lambda v: F.struct(
            F.when(v.isNotNull(), kind.otherwise("card")).alias("kind"), v.alias("value")
        ),
    )


def pseudonymised(
    docs: DataFrame,
    key: str,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its id, the ``text`` with pseudonyms, and the ``pseudonyms``.

    Candidates are checked: card numbers by Luhn, accounts by modulo 97, dates by the calendar
    (1800 to 2199), social numbers and network addresses by their ranges; what fails stays as
    it is and hides no valid one inside or behind it.  An account ends where its country's
    length or the check says, and a phone number before a date or another number (see
    ``phone_pattern``).  The value of a valid one is permuted by the key within its format, so
    equal values are equal everywhere, different ones differ, and checks still hold.  Null
    texts count as empty; repeated rows and null ids stay as they are, ids of any type.  Texts
    of any length are read whole: each pattern repeats groups a bounded number of times.  A
    table without rows gives none; other columns, whatever their names, do not matter.
    """
    body = text_of(text)
    none = F.array().cast("array<string>")
    some = body.rlike("[0-9]|@")
    runs = lambda pattern: F.when(some, F.regexp_extract_all(body, F.lit(pattern), F.lit(1))).otherwise(none)
    valid = docs.select(
        F.col(id_column).alias("_id"), body.alias("_text"),
        F.filter(F.transform(runs(ACCOUNT_RUN), _account_in), lambda m: m.isNotNull()).alias("_accounts"),
        F.filter(runs(CARD_RUN), _luhn).alias("_cards"),
    )
    rows = valid.select("_id", "_text", candidates(F.col("_text"), F.col("_accounts"), F.col("_cards")).alias("_pattern"))
    found = F.when(
        F.col("_text").rlike("[0-9]|@"), F.regexp_extract_all("_text", F.col("_pattern"), F.lit(0))
    ).otherwise(none)
    named = rows.withColumn("_found", found).withColumn("_new", F.transform("_found", lambda m: pseudonym(m, key)))
    between = F.split("_text", F.col("_pattern"), -1)
    values = F.zip_with("_new", "_found", lambda n, m: F.coalesce(n["value"], m))
    woven = F.array_join(
        F.zip_with(between, F.array_append(values, F.lit("")), lambda a, b: F.concat(a, b)), ""
    )
    return named.select(
        F.col("_id").alias(id_column),
        F.when(F.size("_found") == 0, F.col("_text")).otherwise(woven).alias("text"),
        F.filter("_new", lambda n: n["value"].isNotNull()).alias("pseudonyms"),
    )
