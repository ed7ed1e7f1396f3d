"""Operator 4: formats and checks preserved, bijective, linked, reversible."""
import datetime
import hashlib
import re

from curata.llm.pii import ROUNDS, pseudonymize, reveal_text

KEY = "k1"


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def run(spark, texts, key=KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pseudonymize(df, key).orderBy("doc_id").collect()]


def there_and_back(spark, texts, key=KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in reveal_text(pseudonymize(df, key), key).orderBy("doc_id").collect()]


CARDS = ["4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009"]
OTHERS = ["(212) 555-0100", "+1 (212) 555-0100", "212-555-0100", "(012) 155-0100", "212.555.0100", "+1 212 555 0100", "1999/12/31", "123-45-6789", "899-99-9999",
          "10.0.0.1", "255.255.255.255", "1999-12-31", "1900-01-01", "2099-08-04", "12/31/1999", "1/2/2003",
          "a@b.example", "John.Smith+x99@mail.example.com", "ééx@mail.example.com"]


def test_every_format_is_kept_valid_and_reversible(spark):
    values = CARDS + OTHERS
    out = run(spark, [f"see {v}, then." for v in values])
    assert there_and_back(spark, [f"see {v}, then." for v in values]) == [f"see {v}, then." for v in values]
    shape = [re.sub("[0-9]", "9", o) for o in out[:4]]
    assert shape == [re.sub("[0-9]", "9", f"see {v}, then.") for v in values[:4]]
    for o in out[:4]:
        assert luhn(re.sub(r"\D", "", o))
    for v, o in zip(values, out, strict=True):
        assert v not in o or v == "ééx@mail.example.com"
    got = dict(zip(values, (o[4:-7] for o in out), strict=True))
    assert all(0 <= int(x) <= 255 for x in got["10.0.0.1"].split("."))
    assert datetime.date.fromisoformat(got["1999-12-31"])
    assert datetime.datetime.strptime(got["12/31/1999"], "%m/%d/%Y")
    assert re.fullmatch(r"\([2-9]\d\d\) [2-9]\d\d-\d{4}", got["(212) 555-0100"])
    assert got["John.Smith+x99@mail.example.com"].endswith("@mail.example.com")


def test_equal_values_stay_linked_whatever_their_shape(spark):
    a, b = run(spark, ["x 4111111111111111 y", "pay 4111 1111 1111 1111 now"])
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "4111111111111111"


def test_different_values_stay_different(spark):
    texts = [f"10.0.{i}.{j}" for i in range(16) for j in range(32)] + \
        [str(datetime.date(1950, 1, 1) + datetime.timedelta(days=37 * i)) for i in range(300)]
    out = run(spark, texts)
    assert len(set(out)) == len(texts)
    assert run(spark, texts[:5], key="k2") != out[:5]


def test_values_that_fail_their_check_and_text_between_stay(spark):
    texts = ["4111111111111112", "1999-13-31", "666-12-3456", "300.1.1.1", "v1.2.3.4.5", "a1234567890123456b",
             "", None, "no values, only words"]
    assert run(spark, texts) == texts


def test_documents_lose_their_values(documents):
    got = {r.doc_id: r for r in pseudonymize(documents, KEY).collect()}
    pats = [r"[\w.%+-]+@[\w.]+\.\w+", r"\(\d{3}\) \d{3}-\d{4}", r"(?<![\w.])\d{16}(?!\w)", r"(?<![\w.])\d+\.\d+\.\d+\.\d+(?!\w)"]
    seen = 0
    for r in documents.collect():
        for p in pats:
            for v in re.findall(p, r.text):
                if "16" in p and not luhn(v):
                    continue
                seen += 1
                assert v not in got[r.doc_id].text
    assert seen


def test_hostile_and_empty(hostile, hostile_rows, no_rows):
    out = pseudonymize(hostile, KEY).collect()
    assert len(out) == len(hostile_rows)
    row = next(r for r in out if r.doc_id == 14)
    assert (row.n_values, row.n_email, row.n_phone, row.n_ipv4, row.n_card, row.n_iso_date) == (5, 1, 1, 1, 1, 1)
    assert pseudonymize(no_rows, KEY).collect() == []


def plain_feistel(x, y, a, b, tag):
    """The network in plain Python."""
    def number(r, half):
        inner = hashlib.sha256(f"{tag}|{KEY}|{r}|{half}".encode()).hexdigest()
        return int(hashlib.sha256(f"{KEY}|{tag}|{inner}".encode()).hexdigest()[:14], 16)
    for r in range(1, ROUNDS + 1):
        x = (x + number(r, y)) % a
        y = (y + number(-r, x)) % b
    return x, y


def test_against_a_plain_network(spark):
    x, y = plain_feistel(10 * 256 + 1, 2 * 256 + 3, 65536, 65536, "ipv4")
    p, q = plain_feistel(4111111, 11111111, 10**7, 10**8, "card")
    payload = f"{p:07d}{q:08d}"
    card = next(payload + c for c in "0123456789" if luhn(payload + c))
    days = plain_feistel(*divmod((datetime.date(1999, 12, 31) - datetime.date(1900, 1, 1)).days, 270), 270, 270, "date")
    day = datetime.date(1900, 1, 1) + datetime.timedelta(days=days[0] * 270 + days[1])
    assert run(spark, ["10.1.2.3", "4111111111111111", "1999-12-31", "1999/12/31", "-4111111111111111"]) == [
        f"{x // 256}.{x % 256}.{y // 256}.{y % 256}", card, str(day), str(day).replace("-", "/"), f"-{card}"]
