"""Operator 4: values next to other digits, leading 1 and time stamps."""
import random
import re

from test_pii import luhn, run, there_and_back

RUNS = ["4111 1111 1111 1111 12/26", "4111111111111111 123", "2 4111111111111111", "4111111111111111 10.0.0.1",
        "4111 1111 1111 1111 123", "4111-1111-1111-1111 12/26 123", "99 4111 1111 1111 1111", "3400 000000 00009 1234",
        "4111111111111111 5500000000000004", "4111 1111 1111 1111 5500 0000 0000 0004", "4111 1111 1111 1111 2024-01-15",
        "4111111111111111 212-555-0100", "4111 1111 1111 1111 12/31/1999", "4111111111111111-123",
        "+1-212-555-0100", "1-212-555-0100", "2024-01-15T08:30:00Z", "at 2024-01-15T08:30:00Z from 10.0.0.1"]
VALUES = ["4111111111111111", "340000000000009", "5500000000000004", "10.0.0.1", "212-555-0100", "2024-01-15", "12/31/1999"]


def bare(t):
    return re.sub("(?<=[0-9])[ -](?=[0-9])", "", t)


def test_no_value_stays_in_clear_and_all_come_back(spark):
    out = run(spark, RUNS)
    for t, o in zip(RUNS, out, strict=True):
        assert t != o and not [v for v in VALUES if v in o or (v.isdigit() and v in bare(o))], (t, o)
    assert there_and_back(spark, RUNS) == RUNS
    assert out[0].endswith(" 12/26") and out[1].endswith(" 123") and out[2].startswith("2 ")
    assert luhn(out[2][2:]) and out[14].startswith("+1-") and out[16].endswith("T08:30:00Z")


def test_random_cards_among_digits_come_back(spark):
    rnd, texts = random.Random(7), []
    for i in range(300):
        d = "".join(rnd.choice("0123456789") for _ in range(15))
        card = next(d + c for c in "0123456789" if luhn(d + c))
        shape = card if i % 2 else " ".join(card[j:j + 4] for j in range(0, 16, 4))
        texts.append(f"{rnd.choice(['', '7 ', '42 '])}{shape}{rnd.choice(['', ' 123', ' 9', ' 12/26'])}")
    texts += [" ".join(rnd.choice("0123456789") for _ in range(19)) for _ in range(40)]
    out = run(spark, texts)
    assert there_and_back(spark, texts) == texts
    assert all(t != o for t, o in zip(texts[:300], out, strict=False))


def test_digits_without_a_valid_stretch_stay(spark):
    texts = ["4111111111111112 123", "1 2 3 4 5 6", "4111 1111 1111 1112 12/26"]
    assert run(spark, texts) == texts


def test_a_card_has_one_pseudonym_wherever_it_stands(spark):
    rnd, cards = random.Random(11), []
    for _ in range(300):
        d = "".join(rnd.choice("0123456789") for _ in range(15))
        cards.append(next(d + c for c in "0123456789" if luhn(d + c)))
    alone = run(spark, cards)
    for before, after in (("", " 123"), ("37 ", ""), ("", " 12/26")):
        got, same = run(spark, [f"{before}{c}{after}" for c in cards]), 0
        for a, c, o in zip(alone, cards, got, strict=True):
            longer = before.strip() + c + after.strip().split("/")[0]
            if luhn(longer):  # valid by chance: the longer stretch is the value
                continue
            same += 1
            assert o == f"{before}{a}{after}", (c, o)
        assert same > 200
