import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pulse.llm import pii

from tests.conftest import SF

KEY = "a key for tests"


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def run(spark, texts, key=KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(pii.pseudonymise(df, key).collect())
    return [(r.n_found, r.text) for r in rows]


def card(rng, n=16):
    body = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_values_stay_valid_and_linked(spark):
    rng = random.Random(1)
    cards = [card(rng, n) for n in (13, 15, 16, 16, 19) for _ in range(8)]
    days = [dt.date(1, 1, 1) + dt.timedelta(rng.randrange(402_000, 3_500_000)) for _ in range(40)]
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(40)]
    out = run(spark, [f"a {c}, {'-'.join([c[:4], c[4:8], c[8:12], c[12:]])}." if len(c) == 16 else f"a {c}." for c in cards])
    for c, (n, text) in zip(cards, out):
        found = re.findall(r"\d[\d-]+\d", text)
        assert n == len(found) and all(luhn(f.replace("-", "")) and len(f.replace("-", "")) == len(c) for f in found)
        assert len({f.replace("-", "") for f in found}) == 1 and c not in text
    for d, (n, text) in zip(days, run(spark, [
            f"{d:%Y-%m-%d} {d:%m/%d/%Y} {d:%d.%m.%Y} {d:%Y/%m/%d}" for d in days])):
        a, b, c, e = text.split(" ")
        assert n == 4
        day = dt.date.fromisoformat(a)
        assert (f"{day:%m/%d/%Y}", f"{day:%d.%m.%Y}", f"{day:%Y/%m/%d}") == (b, c, e)
        assert (day.year - 1930) // 100 == (d.year - 1930) // 100
    for (n, text) in run(spark, ips):
        assert n == 1 and all(int(x) < 256 for x in text.split("."))


def test_dates_with_month_names(spark):
    (n, text), = run(spark, ["on 29 February 1984, Feb 29, 1984 and 1984-02-29; May 3, 2021 / 3 May 2021; 31 June 2000"])
    assert n == 5 and text.endswith("; 31 June 2000")
    whole, short, iso, a, b = re.search(
        r"on (\d+ \w+ \d{4}), (\w+ \d+, \d{4}) and ([\d-]+); (\w+ \d+, \d{4}) / (\d+ \w+ \d{4});", text).groups()
    day = dt.date.fromisoformat(iso)
    assert whole == f"{day.day} {day:%B} {day.year}" and short == f"{day:%b} {day.day}, {day.year}"
    assert dt.datetime.strptime(a[:3] + a[a.index(" "):], "%b %d, %Y") == dt.datetime.strptime(
        re.sub(r"([A-Z][a-z]{2})[a-z]*", r"\1", b), "%d %b %Y")


def test_one_to_one(spark):
    """Different values never share a pseudonym; equal ones always do."""
    days = [dt.date(2000, 1, 1) + dt.timedelta(k) for k in range(0, 3000)]
    local = [f"{a}{b}{c}@x.org" for a in "abcdefghij" for b in "abcdefghij" for c in "0123456789"]
    ssn = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for s in (1, 777, 9999)]
    for values in ([d.isoformat() for d in days], local, ssn, [f"+1 (212) 555-{k:04d}" for k in range(500)]):
        out = run(spark, values)
        assert all(n == 1 for n, _ in out) and len({t for _, t in out}) == len(values)
    for _, t in run(spark, ssn):
        a, g, s = map(int, t.split("-"))
        assert 1 <= a <= 899 and a != 666 and g and s


def test_iban_mail_and_phone(spark):
    (n, text), = run(spark, ["DE89 3704 0044 0532 0130 00, GB29NWBK60161331926819 and DE89370400440532013000"])
    parts = re.findall(r"DE[\d ]+\d|GB\w+", text)
    assert n == 3 and all(mod97(p) == 1 for p in parts) and parts[0].replace(" ", "") == parts[2]
    assert re.fullmatch(r"GB\d\d[A-Z]{4}\d{14}", parts[1])
    (n, text), = run(spark, ["that.71@mail4.example.com THAT.71@MAIL4.EXAMPLE.COM!! +1 (017) 555-7713 12 017-555-7713 +49 30 901820"])
    assert n == 5
    m = re.fullmatch(r"([a-z]{4}\.\d\d)@mail4\.example\.com [A-Z]{4}\.\d\d@MAIL4\.EXAMPLE\.COM!! "
                     r"\+1 \((\d{3})\) (\d{3})-(\d{4}) 12 (\d{3})-(\d{3})-(\d{4}) \+49 \d\d \d{6}", text)
    assert m and m.group(1) != "that.71" and m.groups()[1:4] == m.groups()[4:]


@pytest.mark.parametrize("text", [
    "4539148803436468", "0000000000000000", "300.1.2.3", "1.2.3.4.5", "2023-02-30 31/31/2000 30.02.2001", "000-12-3456 666-12-3456 900-12-3456",
    "DE88370400440532013000", "version 2.0, 10 000 items, 3.14", "04dbebab91ab85687d33eeaaf9ac699e1188f962", "a@b", "x" * 50000, "1" * 50000,
    "", "A.B.C 12345 é 🙂"])
def test_invalid_values_and_other_text_stay(spark, text):
    assert run(spark, [text]) == [(0, text)]


def test_addresses_before_full_stops(spark):
    ends = [". Next", ".", "... ok", ".)", ".\nNext", ", x", ""]
    out = run(spark, [f"Mail bob@mail.example.com{end}" for end in ends])
    local = out[0][1][5:8]
    assert local != "bob" and out == [(1, f"Mail {local}@mail.example.com{end}") for end in ends]


@pytest.mark.parametrize("before,value,after", [
    ("", "+49 30 901820", " 2024-01-01"), ("", "+44 20 7946 0958", " 10 times"), ("", "+49 30 901820", " 10 times"),
    ("2024 ", "4111 1111 1111 1111", ""), ("1234 5678 ", "4111-1111-1111-1111", " 12"), ("in 31 ", "4111 1111 1111 1111", " 123 4567"),
    ("", "BE68 5390 0754 7034", " OK"), ("", "DE89 3704 0044 0532 0130 00", " ABC 12"), ("XX12 3456 7890 ", "BE68 5390 0754 7034", " OK"),
    ("1234 5678 9012 ", "10.0.0.1", "\n"), ("12 a@b.org 1234 5678 9012 3456 ", "555-123-4567", " 1.2.3.4.5"),
    ("31 February ", "2024-02-03", ""), ("+99 12 ", "555-123-4567", "")])
def test_neighbours_do_not_hide_a_value(spark, before, value, after):
    """A value keeps its pseudonym whatever numbers and words are next to it."""
    (_, alone), (n, text) = run(spark, [value, before + value + after])
    assert alone != value and n >= 1
    clean = before.replace("a@b.org", run(spark, ["a@b.org"])[0][1])
    if "2024-01-01" in after:
        after = after.replace("2024-01-01", run(spark, ["2024-01-01"])[0][1])
    assert text == clean + alone + after


def test_keys_differ(spark):
    assert run(spark, ["born 1984-02-29"]) != run(spark, ["born 1984-02-29"], key="another")


def test_whole_table_keeps_all_but_the_values(spark):
    docs = spark.read.parquet(f"{SF['0.001']}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    out = pii.pseudonymise(docs, KEY)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    changed = 0
    for r in out.collect():
        assert re.sub(r"[0-9]+", "0", r.text) == re.sub(r"[0-9]+", "0", before[r.doc_id]) or "@" in r.text
        assert (r.text == before[r.doc_id]) == (r.n_found == 0)
        changed += r.n_found > 0
    assert changed > 0


def test_odd_rows(spark):
    rows = [(1, None, 9, "p"), (None, "ip 10.0.0.1", 8, "q"), (1, "", 7, "r"), (2, "x 10.0.0.1 " * 3000, 6, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_found int, m string")
    out = pii.with_pseudonyms(df, KEY)
    assert out.columns == ["doc_id", "text", "m", "n_found"]
    got = {r.m: r for r in out.collect()}
    assert (got["p"].text, got["p"].n_found) == (None, 0) and (got["r"].text, got["r"].n_found) == ("", 0)
    new = got["q"].text[3:]
    assert got["s"].text == f"x {new} " * 3000 and got["s"].n_found == 3000
    assert pii.pseudonymise(df.limit(0), KEY).collect() == []
