"""Secret scan: base patterns against a plain loop, guess cost against all segmentations."""

import hashlib
import itertools
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidepool.llm import secret_scan as ss

WORDS = ss.Words()


def slow_base(text):
    """The contract's patterns as written: leftmost, non-overlapping, failing matches dropped afterwards."""
    out = []
    key = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


PARTS = ["password", "Token", "api_key", "APIKEY", "ſecret", "paſſwd", "toKen", "=", ":", " ", '"', "'", "abc", "abcdefgh", "x=y", "AKIA", "AKIAABCDEFGH12345", "AKIAAKIA",
         "0123456789abcdef" * 2, "deadbeef", "é", "漢", "\n", "secret=", "\t", ".", "-_/+", "ABCDEFGHIJKL"]


def test_base_spans():
    rng = random.Random(1)
    for _ in range(6000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 9)))
        assert ss.listed(ss.base_spans(text)) == slow_base(text), text


def slow_cost(value):
    """Cheapest of all ways to cut a value into known spans and brute-force spans."""
    known = {}
    for i, j, c, _ in ss.spans(value, WORDS):
        known[i, j] = min(c, known.get((i, j), math.inf))
    best = math.inf
    for cuts in itertools.product((False, True), repeat=len(value) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(value)]
        pieces = list(zip(at, at[1:]))
        total = ss.SEGMENT * (len(pieces) - 1)
        for i, j in pieces:
            total += min(known.get((i, j), math.inf), sum(ss.BRUTE[ss._class(c)] for c in value[i:j]))
        best = min(best, total)
    return best


@pytest.mark.parametrize("value", ["password", "P4ssw0rd1", "qwerty123", "aaaaaa", "19870512", "2024-01-31", "xK9#mQ2", "dragonaaa1", "Summer2024", "drowssap", "zxcvbnm1", "a", "éé漢", "12.05.1987", "abcdefg"])
def test_guess_cost_of_known_shapes(value):
    assert ss.guess_cost(value, WORDS) == pytest.approx(slow_cost(value))


def test_guess_cost_of_random_values():
    rng = random.Random(2)
    for _ in range(150):
        value = "".join(rng.choices(["a", "aa", "1", "9", "the", "pass", "qwe", "Z", "#", "2001", "é", "love"], k=rng.randint(1, 4)))[:11]
        assert ss.guess_cost(value, WORDS) == pytest.approx(slow_cost(value))


def test_costs_order_weak_and_strong():
    cost = lambda v: ss.guess_cost(v, WORDS)
    assert cost("password") < cost("P4ssword") < cost("Tr0ub4dor&3") < cost("x9$Lq!7Wz@Pk")
    assert cost("a" * 5000) < 10 and cost("q7" * 2000) > 1000


def test_credential_values():
    text = 'pwd: "x9$Lq!7Wz@Pk", passphrase is fh39#kd0Qzz9. Bearer abcDEF123ghiJKL456, postgres://bob:s3cr3tPqz9!x@db1 password: password1'
    spans = ss.find(text, WORDS)
    values = [text[s:e] for s, e, k, _ in spans if k == "guess"]
    assert values == ["x9$Lq!7Wz@Pk", "fh39#kd0Qzz9", "abcDEF123ghiJKL456", "s3cr3tPqz9!x"]
    assert ss.find("The passengers pass by the keys, and the pinball token ring.", WORDS) == []


def test_dataframe(spark):
    rows = [(1, 'token = "' + "ab12" * 10 + '"', 7), (1, 'token = "' + "ab12" * 10 + '"', 7), (None, None, 7), (2, "", 7), (3, "x " * 100_000 + "AKIAABCDEFGH12345", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, SPANS int")
    got = ss.scan(df)
    assert got.columns == ["doc_id", "text", *ss._FOUND.names]
    for r in got.collect():
        assert r.base_spans == slow_base(r.text or "")
        assert set(filter(None, r.base_spans.split(","))) <= set(filter(None, r.spans.split(",")))
    assert ss.scan(df.limit(0)).collect() == []
    from tidepool.llm.registry import op1_digest
    digest = {r.doc_id: r for r in op1_digest(df).collect()}
    assert digest[2].base_sha256 == hashlib.sha256(b"").hexdigest() and digest[3].n_access == 1


def guesses(text):
    return [text[s:e] for s, e, k, _ in ss.find(text, WORDS) if k == "guess"]


def test_words_after_credential_names_are_clean():
    for text in ("your token is invalid", "the password is incorrect", "the secret is simplicity", "Password is required.", "password: mandatory", "the passphrase is misconfigured",
                 "token is responsible/accountable", "the password is неправильный", "pass is Rechtsschutzversicherung", "the secret is kindheartedness", "Das token is unvollständig",
                 "密码 token is 不正确的密码值", "pwd: ungültig", "secret = oubliée", "password is WRONG-USERNAME!"):
        assert guesses(text) == [], text
    assert len(ss.GENERAL) > 30_000


def test_code_is_clean():
    for text in ("password = getpass.getpass()", "api_key = os.environ['KEY']", "password: ${DB_PASSWORD}", "token = request.headers.get('X-Auth')", "pwd=$PGPASSWORD", "secret: {{ vault_secret }}",
                 "password = settings.DATABASE_PASSWORD", "password=%(password)s", "pwd = user_password_field", "access_token: <your-token>", "token = generate_token(length)", "PASSWORD=$(cat /run/secret)"):
        assert guesses(text) == [], text
    assert guesses("pwd: x9$(Lq!7Wz@") and guesses("pwd: $x9Lq!7Wz@") and guesses("secret = qzxvkjwpfhg") and guesses('password: "correcthorsebatterystaplewagon"')


def test_random_letters_are_no_words():
    rng = random.Random(4)
    values = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(500)]
    assert sum(bool(guesses(f"the password is {v}")) for v in values) > 450
    assert sum(ss.wordlike(w) for w in ss.GENERAL if len(w) > 5) > 0.95 * sum(len(w) > 5 for w in ss.GENERAL)


def test_neighbours_do_not_matter(spark):
    """The same spans whatever the table: each text alone, with 1,200 others of its words, or repeated."""
    texts = ["the password is zworgelfrm", "pwd: hrmplqw9x", "token: Ab3$efgh!j"]
    more = [f"{w} zworgelfrm hrmplqw9x" for w in ss.GENERAL[:1200]]
    alone = {t: ss.listed(ss.find(t, WORDS)) for t in texts}
    for table in (texts, texts + more, texts * 3):
        got = ss.scan(spark.createDataFrame([(t,) for t in table], "text string")).where(F.col("text").isin(texts)).collect()
        assert {r.text: r.spans for r in got} == alone


@pytest.mark.parametrize("n, times", [(250, 3), (1000, 3), (3000, 3), (40, 200), (5000, 2)])
def test_long_repeats_take_time_in_proportion(n, times):
    rng = random.Random(n)
    block = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=n))
    began = time.time()
    cost = ss.guess_cost(block * times, WORDS, blocks=True)
    assert cost < 1.1 * ss.guess_cost(block, WORDS, blocks=True) + 4 and time.time() - began < 1 + n * times / 2000


def test_long_value_of_several_repeats():
    rng = random.Random(8)
    parts = ["".join(rng.choices("abcdefXYZ0123456789+/", k=400)) * 2 for _ in range(5)]
    began = time.time()
    assert ss.guess_cost("".join(parts), WORDS, blocks=True) < 5 * 400 * 1.5 and time.time() - began < 10


def cheapest_by_hand(value, known=None):
    """Cheapest of all ways to cut a value, every piece judged by itself: word, date, walk, repeat of any block, brute force."""
    known = {} if known is None else known
    if value in known:
        return known[value]

    def piece(i, j):
        part, costs = value[i:j], [sum(ss.BRUTE[ss._class(c)] for c in value[i:j])]
        if len(part) >= 3:
            c = WORDS.cost(part)
            costs += [] if c is None else [c]
            for row in ss.KEYBOARD:
                if part.lower() in row or part.lower() in row[::-1]:
                    costs.append(math.log10(len(ss.KEYBOARD) * 2 * len(row)) + math.log10(len(part)))
        m = ss._DATE.match(value, i)
        if m and m.end() == j:
            costs.append(math.log10(365 * 120) + (0.6 if m[1] or m[2] else 0) if j - i > 4 else math.log10(120))
        for p in range(1, len(part) // 2 + 1):
            block = part[:p]
            primitive = not any(p % d == 0 and block[:d] * (p // d) == block for d in range(1, p))
            if primitive and len(part) % p == 0 and block * (len(part) // p) == part and len(part) // p >= (3 if p == 1 else 2):
                costs.append(cheapest_by_hand(block, known) + math.log10(len(part) // p))
        return min(costs)

    best = [0.0] + [math.inf] * len(value)
    for j in range(1, len(value) + 1):
        best[j] = min(best[i] + (ss.SEGMENT if i else 0) + piece(i, j) for i in range(j))
    known[value] = best[-1]
    return best[-1]


def test_guess_cost_is_the_cheapest_segmentation_with_repeated_blocks():
    cost = lambda v: ss.guess_cost(v, WORDS, blocks=True)
    for value in ("abcabcabcabc", "asdasdasdasd", "blahblahblah", "abcdefghello"):
        assert cost(value) < ss.THRESHOLD, value
    assert ss.guess_cost("abcdefghello", WORDS) < ss.THRESHOLD and ss.find("pwd: x9Kx9Kx9Kx9K", WORDS) == []
    rng = random.Random(3)
    for alphabet in (["a", "b"], ["a", "bc", "1", "Z"], ["abc", "hello", "qwe", "x", "9", "ll", "abcdefg", "2001", "é"]):
        for _ in range(80):
            value = "".join(rng.choices(alphabet, k=rng.randint(1, 9)))
            value = value * rng.choice((1, 1, 2, 3)) + rng.choice(("", value[:2], "hello"))
            assert cost(value) == pytest.approx(cheapest_by_hand(value)), value
    assert cost("q7" * 2000) < 7 and cost("a" * 5000) < 6 and cost("".join(rng.choices("abcXYZ019#", k=3000))) > 1000


@pytest.mark.parametrize("text,value", [
    ('passphrase: "correct horse battery staple"', "correct horse battery staple"), ("'passphrase' : 'correct horse battery staple', 1", "correct horse battery staple"),
    ('pwd="x9$ \\"Lq!7 Wz"', 'x9$ \\"Lq!7 Wz'), ("pwd:            x9$Lq!7Wz@", "x9$Lq!7Wz@"), ("pwd \t      =\t\t     x9$Lq!7Wz@", "x9$Lq!7Wz@"),
    ("Bearer      abcDEF123ghiJKL456", "abcDEF123ghiJKL456"), ("redis://:x9$Lq!7Wz@host", "x9$Lq!7Wz"), (f"ftp://{'u' * 200}:x9$Lq!7Wz@host", "x9$Lq!7Wz"),
    ("dbPwd=x9$Lq!7Wz@", "x9$Lq!7Wz@"), ("DBPASS=x9$Lq!7Wz@", "x9$Lq!7Wz@"), ("userpass: x9$Lq!7Wz@", "x9$Lq!7Wz@"), ("mainPass: x9$Lq!7Wz@", "x9$Lq!7Wz@"),
    ("authtoken=x9$Lq!7Wz@", "x9$Lq!7Wz@"), ("cardPin: x9$Lq!7Wz@", "x9$Lq!7Wz@")])
def test_forms_of_credentials(text, value):
    assert [text[s:e] for s, e, k, _ in ss.find(text, WORDS) if k == "guess"] == [value]


def test_names_that_are_part_of_other_words():
    for text in ("bypass: x9$Lq!7Wz@", "compass=x9$Lq!7Wz@", "the spin is x9$Lq!7Wz@", "passport: x9$Lq!7Wz@", 'pwd: "x9$Lq!\n7Wz@qP"', "http://host:8080/a@bcdefgh"):
        assert ss.find(text, WORDS) == [], text
