import datetime
import hashlib
import random
import re

import regex

from rollcall.llm import pii, queries
from tests.compare import duckdb_tables
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.01"
KEY = "k"


def noise(tweak, turn, other):
    return int(hashlib.sha256(f"{KEY}|{tweak}|{turn}|{other}".encode()).hexdigest()[:15], 16)


def brute_pair(high, low, highs, lows, tweak):
    for turn in range(pii.ROUNDS):
        if turn % 2 == 0:
            high = (high + noise(tweak, turn, low)) % highs
        else:
            low = (low + noise(tweak, turn, high)) % lows
    return high, low


def brute_digits(digits, tweak):
    half = len(digits) // 2
    rest = len(digits) - half
    high, low = brute_pair(int(digits[:half]), int(digits[half:]), 10**half, 10**rest, tweak)
    return f"{high:0{half}d}{low:0{rest}d}"


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def made(spark, values, key=KEY):
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    return {r.doc_id: r for r in pii.pseudonymised(df, key).collect()}


def test_cards(spark):
    values = ["4111111111111111", "4111 1111 1111 1111", "378282246310005", "4111111111111112", "6011-0009-9013-9424"]
    rows = made(spark, values)
    for i, value in enumerate(values):
        digits, new = re.sub("[^0-9]", "", value), re.sub("[^0-9]", "", rows[i].text)
        if not luhn(digits):
            assert rows[i].text == value and rows[i].pseudonyms == []
            continue
        assert luhn(new) and new[:-1] == brute_digits(digits[:-1], "card")
        assert re.sub("[0-9]", "9", rows[i].text) == re.sub("[0-9]", "9", value)
    assert rows[1].text.replace(" ", "") == rows[0].text


def test_addresses_phones_social(spark):
    values = ["1.2.3.4", "256.1.1.1", "10.01.1.1", "+1 (343) 555-6039", "343-555-6039", "+44 20 7946 0958", "123-45-6789", "666-45-6789"]
    rows = made(spark, values)
    high, low = brute_pair(1 * 256 + 2, 3 * 256 + 4, 65536, 65536, "address")
    assert rows[0].text == f"{high // 256}.{high % 256}.{low // 256}.{low % 256}"
    assert [rows[i].text for i in (1, 2, 7)] == [values[i] for i in (1, 2, 7)]
    phone = brute_digits("3435556039", "phone")
    assert rows[3].text == f"+1 ({phone[:3]}) {phone[3:6]}-{phone[6:]}" and rows[4].text == f"{phone[:3]}-{phone[3:6]}-{phone[6:]}"
    assert re.sub("[^0-9]", "", rows[5].text) == "44" + brute_digits("2079460958", "phone")
    high, low = brute_pair(122, 44 * 9999 + 6788, pii.AREAS, pii.GROUPS * pii.SERIALS, "social")
    area = high + 1 + (high + 1 >= 666)
    assert rows[6].text == f"{area:03d}-{low // 9999 + 1:02d}-{low % 9999 + 1:04d}"


def test_dates(spark):
    first = datetime.date(1800, 1, 1)

    def moved(date):
        day = (date - first).days
        high, low = brute_pair(day // 773, day % 773, 189, 773, "date")
        return first + datetime.timedelta(days=high * 773 + low)

    values = ["2000-02-29", "29.02.2000", "01/13/1999", "2001-02-29", "99/99/1999", "1799-12-31"]
    rows = made(spark, values)
    leap = moved(datetime.date(2000, 2, 29))
    assert rows[0].text == leap.isoformat() and rows[1].text == leap.strftime("%d.%m.%Y")
    assert rows[2].text == moved(datetime.date(1999, 1, 13)).strftime("%m/%d/%Y")
    assert [rows[i].text for i in (3, 4, 5)] == values[3:]


def test_accounts_and_mail(spark):
    values = ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765433", "Hein.19@mail5.example.com", "a@b.co"]
    rows = made(spark, values)
    new = rows[0].text
    assert int("".join(str(int(c, 36)) for c in new[4:] + new[:4])) % 97 == 1
    assert new[8:] == brute_digits("12345698765432", "account") and new[4:8] == "WEST"
    assert rows[1].text.replace(" ", "") == new and rows[2].text == values[2]
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[0-9]{2}@mail5\.example\.com", rows[3].text) and rows[3].text != values[3]
    assert re.fullmatch(r"[a-z]@b\.co", rows[4].text)


def test_permutations_are_one_to_one(spark):
    values = [f"10.0.{a}.{b}" for a in range(4) for b in range(256)] + [f"{i:04d}-01-01" for i in range(1800, 2200)]
    rows = made(spark, [" ".join(values)])[0]
    new = rows.text.split(" ")
    assert len(set(new)) == len(values) and len(rows.pseudonyms) == len(values)
    assert made(spark, [values[0]], "other")[0].text != new[0]


def alone(spark, values):
    rows = made(spark, values)
    return [rows[i].text for i in range(len(values))]


def test_neighbours_of_accounts(spark):
    account, date, card, mail = "ES91 2100 0418 4502 0005 1332", "2024-05-01", "4111 1111 1111 1111", "a@b.co"
    a, d, c, m, f = alone(spark, [account, date, card, mail, "FR14 2004 1010 0505 0001 3M02 606"])
    assert a != account and d != date and c != card
    texts = {
        f"{account} USD": f"{a} USD", f"{account} {date}": f"{a} {d}", f"{account} 2024": f"{a} 2024",
        f"{account.replace(' ', '')} {date}, {mail}": f"{a.replace(' ', '')} {d}, {m}",
        f"ID12 {card}": f"ID12 {c}", f"AB12 CD34 {account}": f"AB12 CD34 {a}", f"DE12 {card} 42": f"DE12 {c} 42",
        f"{account} {card} {account} EUR": f"{a} {c} {a} EUR", f"2024 {card}": f"2024 {c}",
        "FR14 2004 1010 0505 0001 3M02 606 FR14 2004 1010 0505 0001 3M02 606 X": f"{f} {f} X",
        f"99/99/{card}": f"99/99/{c}", "ES91 2100 0418 4502 0005 1333 USD": "ES91 2100 0418 4502 0005 1333 USD",
    }
    assert alone(spark, list(texts)) == list(texts.values())


def test_neighbours_of_phones(spark):
    phones = ["+49 30 1234567", "+44 20 7946 0958", "+33 1 23 45 67 89", "+1 (343) 555-6039", "+7 495 123-45-67", "343-555-6039"]
    date, card = "2024-01-01", "4111 1111 1111 1111"
    new = dict(zip([*phones, date, card], alone(spark, [*phones, date, card]), strict=True))
    assert all(k != v for k, v in new.items())
    pairs = [(p, x) for p in phones for x in (date, card, "2024", "17 EUR", "01.02.2003"[:2])]
    want = [f"{new[p]} {new.get(x, x)}" for p, x in pairs]
    assert alone(spark, [f"{p} {x}" for p, x in pairs]) == want
    spaced, dotted, dashed = alone(spark, ["+31 20 123 45 67", "+31 20.123.45.67", "+49 123-45-6789"])
    assert dotted.replace(".", " ") == spaced and dashed.startswith("+49 ") and dashed != "+49 123-45-6789"
    assert alone(spark, [f"+39 06 1234 5678 {x}" for x in (date, "123-45-6789")]) == [
        f"{alone(spark, ['+39 06 1234 5678'])[0]} {x}" for x in (new[date], alone(spark, ["123-45-6789"])[0])
    ]
    assert alone(spark, [f"+49 30 1234 5678 {date}"]) == [f"{alone(spark, ['+49 30 1234 5678'])[0]} {new[date]}"]


def test_mail_in_a_longer_run(spark):
    for n in (3, 64, 65, 200):
        text = "-" * n + "john@example.com"
        new = alone(spark, [text])[0]
        assert len(new) == len(text) and new.endswith("@example.com") and "john" not in new


def test_dates_of_the_calendar(spark):
    first, texts, bad = datetime.date(1800, 1, 1), [], []
    for y in (1800, 1900, 1904, 1999, 2000, 2004, 2100, 2199):
        for mo in range(0, 14):
            for d in (0, 1, 28, 29, 30, 31, 32):
                try:
                    datetime.date(y, mo, d)
                    texts.append(f"{y}-{mo:02d}-{d:02d}")
                except ValueError:
                    bad.append(f"{y}-{mo:02d}-{d:02d}")
    rows = made(spark, [" ".join(texts), " ".join(bad), "31.12.2199 12/31/1800 30-04-2001"])
    assert len(rows[0].pseudonyms) == len(texts) and rows[1].pseudonyms == [] and len(rows[2].pseudonyms) == 3
    assert all(datetime.date.fromisoformat(x) >= first for x in rows[0].text.split(" "))


def test_given_texts(spark):
    docs = dict(duckdb_tables(SMALL).execute("SELECT doc_id, text FROM documents").fetchall())
    rows = queries.registered()["op10_pii"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    names, cards = set(), 0
    for r in rows:
        text = docs[r.doc_id]
        for m in re.findall(r"[\w.+-]+@[\w-]+\.[\w.]*\w", text):
            names.add(m)
            assert m not in r.text
        for m in re.findall(r"(?<![0-9])[0-9]{16}(?![0-9])", text):
            if luhn(m):
                cards += 1
                assert m not in r.text
        if not re.search("[0-9]|@", text):
            assert r.text == text
        assert len(r.text) >= len(text) - 40
    assert names and cards


def test_awkward(awkward, nothing):
    rows = pii.pseudonymised(awkward, KEY).collect()
    assert len(rows) == len(TEXTS) and all(r.text is not None for r in rows)
    assert [len(r.pseudonyms) for r in rows if r.doc_id == 12] == [1]
    texts = {i: t for i, t in TEXTS}
    assert all(r.text == texts[r.doc_id] for r in rows if r.doc_id in (1, 9, 11, 13))
    assert pii.pseudonymised(nothing, KEY).collect() == []


def test_long_runs(spark):
    # Domains, digits, dots, dashes and groups of any length end no task.
    many = 100_000
    mail = "Hein.19@mail5.example.com"
    runs = [
        "x@" + "a." * many + "com", "x@" + "a-" * many + ".com", "x@" + "ab." * many + "com", "1" * many, "." * many,
        "-" * many, "1." * many, "1-" * many, "1 " * many, "+49 " + "1 " * many, "AB12 " + "CD34 " * many,
        "AB12" + "X9" * many, "a" * many + "@b.co", "2024-05-0" * many, "+" * many, "(" * many, "@" * many,
    ]
    rows = made(spark, [f"{run} ;; {mail}" for run in runs] + [mail])
    new = rows[len(runs)].text
    assert new != mail
    for i, run in enumerate(runs):
        assert rows[i].text.endswith(f" ;; {new}")
        assert len(rows[i].text) == len(run) + 4 + len(mail)
    assert [rows[i].text[: len(runs[i])] == runs[i] for i in (4, 5, 14, 15, 16)] == [True] * 5


LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
ALNUM = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LETTERS, DIGITS = {c for c in ALNUM if c.isalpha()}, set("0123456789")


def at(text, i):
    return text[i] if 0 <= i < len(text) else ""


def run_end(text, i, chars, most=10**9):
    j = i
    while j < len(text) and j - i < most and text[j] in chars:
        j += 1
    return j


def domain_end(text, i):
    """The end of the domain with the most labels, then the most letters, behind a sign at ``i``."""
    if at(text, i) != "@":
        return None
    ends, j = [], i + 1
    while len(ends) < 126:
        k = run_end(text, j, ALNUM | {"-"}, 63)
        if k == j or at(text, k) != ".":
            break
        j = k + 1
        ends.append(j)
    for j in reversed(ends):
        k = run_end(text, j, LETTERS)
        if k - j >= 2:
            return k
    return None


def email_end(text, i):
    if at(text, i) not in LOCAL:
        return None
    first = i == 0 or text[i - 1] not in LOCAL
    j = run_end(text, i, LOCAL, 64)
    if first:
        return domain_end(text, j)
    # The last 64 signs of a longer run.
    start = i
    while start and text[start - 1] in LOCAL:
        start -= 1
    whole = run_end(text, start, LOCAL) - start
    return domain_end(text, j) if j - i == 64 and whole >= 65 else None


def date_end(text, i):
    if i and text[i - 1] in DIGITS | set("./-"):
        return None
    part = text[i : i + 10]
    if at(text, i + 10) in DIGITS and at(text, i + 10):
        return None
    forms = [(r"(\d{4})-(\d\d)-(\d\d)", "ymd"), (r"(\d\d)([./-])(\d\d)\2(\d{4})", None)]
    for pattern, order in forms:
        m = re.fullmatch(pattern, part, re.ASCII)
        if not m:
            continue
        tries = [(m[1], m[2], m[3])] if order else [(m[4], m[3], m[1]), (m[4], m[1], m[3])]
        for y, mo, d in tries:
            try:
                if 1800 <= datetime.date(int(y), int(mo), int(d)).year < 2200:
                    return i + 10
            except ValueError:
                pass
    return None


def social_end(text, i):
    m = re.compile(r"(\d{3})-(\d\d)-(\d{4})", re.ASCII).match(text, i)
    if not m or (i and text[i - 1] in DIGITS | {"-"}) or (at(text, m.end()) and at(text, m.end()) in DIGITS | {"-"}):
        return None
    bad = m[1] in ("000", "666") or m[1][0] == "9" or m[2] == "00" or m[3] == "0000"
    return None if bad else m.end()


def address_end(text, i):
    if i and text[i - 1] in DIGITS | {"."}:
        return None
    m = re.compile(r"\d+\.\d+\.\d+\.\d+", re.ASCII).match(text, i)
    if not m or (at(text, m.end()) == "." and at(text, m.end() + 1) and at(text, m.end() + 1) in DIGITS):
        return None
    octets = m[0].split(".")
    return m.end() if all(str(int(o)) == o and int(o) < 256 for o in octets) else None


def valid_cards(text):
    found = set()
    for i in range(len(text)):
        if text[i] in DIGITS and (i == 0 or text[i - 1] not in DIGITS):
            m = re.compile(r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)", re.ASCII).match(text, i)
            if m and luhn(re.sub("[^0-9]", "", m[0])):
                found.add(m[0])
    return found


def valid_accounts(text):
    known = {c: n for n, codes in pii.ACCOUNT_LENGTHS.items() for c in codes.split()}
    shape = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?[A-Za-z0-9]*")
    found = set()
    for i in range(len(text)):
        m = shape.match(text, i) if i == 0 or text[i - 1] not in ALNUM else None
        best = None
        words = m[0].split(" ") if m else []
        for n in range(1, len(words) + 1):
            a = "".join(words[:n])
            if re.fullmatch("[A-Z0-9]{15,34}", a) and len(re.sub("[^0-9]", "", a[4:])) >= 2:
                if int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1:
                    best = max(best or (False, 0, ""), (known.get(a[:2]) == len(a), len(a), " ".join(words[:n])))
        if best:
            found.add(best[2])
    return found


def brute_found(text):
    """Kind, start and end of what is found, place by place; phones by their pattern alone."""
    cards, accounts = valid_cards(text), valid_accounts(text)
    one_of = lambda values: "|".join(map(regex.escape, sorted(values, key=lambda v: (-len(v), v))))
    stops = pii._STOPS + (f"|(?<![0-9])(?=[0-9])(?:{one_of(cards)})(?![0-9])" if cards else "")
    phones = regex.compile(pii.phone_pattern(stops))

    def set_end(values, chars):
        def end(text, i):
            if i and text[i - 1] in chars:
                return None
            ends = [i + len(v) for v in values if text.startswith(v, i) and at(text, i + len(v)) not in chars]
            return max(ends, default=None)

        return end

    def phone_end(text, i):
        m = phones.match(text, i)
        return m.end() if m else None

    kinds = [
        ("email", email_end), ("account", set_end(accounts, ALNUM)), ("date", date_end), ("social", social_end),
        ("address", address_end), ("phone", phone_end), ("card", set_end(cards, DIGITS)),
    ]
    found, i = [], 0
    while i < len(text):
        for kind, end in kinds:
            j = end(text, i)
            if j:
                found.append((kind, i, j))
                i = j
                break
        else:
            i += 1
    return found


def test_all_kinds_against_a_slow_finder(spark):
    rnd = random.Random(11)
    parts = [
        "a@b.co", "Hein.19@mail5.example.com", "x" * 70 + "@long.example.org", "@b.co", "a@b", "a@b.c1.de", "q@-.x.yz",
        "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765433", "ES91 2100 0418 4502 0005 1332",
        "AB12", "CD34", "2024-05-01", "2023-02-29", "2000-02-29", "29.02.2000", "31/12/1999", "12-31-1999", "1.1.2000",
        "123-45-6789", "666-45-6789", "1.2.3.4", "256.1.1.1", "10.0.0.255", "10.0.0.255.1", "4111 1111 1111 1111",
        "4111111111111111", "4111111111111112", "378282246310005", "3782 822463 10005", "+49 30 1234567",
        "+1 (343) 555-6039", "343-555-6039", "+44 20 7946 0958", "(343) 555-6039", "42", "2024", "USD", "x", "é", "日本",
    ]
    joins = [" ", " ", " ", "", "-", ".", ", ", "\n", "/", ":", "+"]
    texts = ["".join(rnd.choice(parts) + rnd.choice(joins) for _ in range(rnd.randint(1, 9))) for _ in range(1500)]
    rows, kinds = made(spark, texts), set()
    for i, text in enumerate(texts):
        found, new = brute_found(text), rows[i].text
        assert [p.kind for p in rows[i].pseudonyms] == [k for k, _, _ in found], (text, new, found)
        want, last = "", 0
        for (kind, a, b), p in zip(found, rows[i].pseudonyms, strict=True):
            want, last = want + text[last:a] + p.value, b
            kinds.add(kind)
        assert new == want + text[last:], (text, found)
    assert kinds == set(pii.KINDS)
