import hashlib
import itertools
import re

import pandas as pd
import pytest
import regex

from pointframe.llm import pii
from pointframe.llm import queries as Q


def test_query(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")
    got = Q.op9_pii(spark, sf).toPandas().set_index("doc_id")
    assert set(got.index) == set(docs.index) and got.index.is_unique
    rx = re.compile(r"[\w%+-]+(?:\.[\w%+-]+)*@\w+\.\w+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)|(?<!\d)\d{16}(?!\d)")
    there, back, hit = {}, {}, 0
    for i, text in docs.text.items():
        old, new = rx.findall(text), rx.findall(got.text[i])
        assert len(old) <= got.n_entities[i] and len(old) == len(new)
        assert rx.sub("#", text) == rx.sub("#", got.text[i])
        for a, b in zip(old, new, strict=True):
            hit += 1
            assert a != b and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", b) or "@" in a or "." in a
            assert there.setdefault(a, b) == b and back.setdefault(b, a) == a  # coreference and distinctness
    assert hit > 30 and not set(there) & set(back)


def test_kinds_forms_and_coreference(spark):
    text = {
        1: "Call +1 (017) 555-7713 or +1 017 555 7713. Mail Ann.Lee@Mail.example.com, ann.lee@mail.example.com; card 4111 1111 1111 1111",
        2: "card 4111111111111111, 4111-1111-1111-1111, ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00 at 10.20.30.40.",
        3: "Mr. John Smith met Mrs. Smith and Frau Müller; Herr Müller; Господин Иван Петров",
        7: "...und.34@mail7.example.com, word.und.34@mail7.example.com -x.1@a.example.org",
        4: "version 1.2.3, call 12345, a@b, 1234567890123456789, plain Smith",
        5: None,
        6: "",
    }
    df = spark.createDataFrame(list(text.items()), "doc_id long, text string").selectExpr("*", "'x' as kinds", "1 as h1")
    got = {r.doc_id: r for r in pii.replace_private(df, "k").collect()}
    a, b, c = (got[i].text for i in (1, 2, 3))
    digits = lambda s: re.sub(r"\D", "", s)
    phones = re.search(r"Call (\+\d \(\d{3}\) \d{3}-\d{4}) or (\+\d \d{3} \d{3} \d{4})\.", a)
    assert phones and digits(phones[1]) == digits(phones[2]) != "10175557713"
    mails = re.search(r"Mail (\w+\.\w+@\w+\.\w+\.com), (\S+);", a)
    assert mails[1].lower() == mails[2] != "ann.lee@mail.example.com" and mails[1][0].isupper()
    cards = [re.search(r"card ((?:\d{4} ){3}\d{4})", a)[1], *re.search(r"card (\d{16}), ((?:\d{4}-){3}\d{4})", b).groups()]
    assert len({digits(x) for x in cards}) == 1
    assert re.search(r"ssn \d{3}-\d{2}-\d{4}, iban DE\d\d(?: \d{4}){4} \d\d at (\d+\.){3}\d+\.$", b)
    names = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) and Frau (\w+); Herr (\w+); Господин ([А-я]+) ([А-я]+)", c)
    assert names and names[2] == names[3] != "Smith" and names[4] == names[5] != "Müller" and names[2] != names[4]
    assert names[1] in pii.FIRST_NAMES["latin", "man"] and names[6] in pii.FIRST_NAMES["cyrillic", "man"]
    assert got[7].n_entities == 3 and not re.search("und|mail7", got[7].text) and got[7].text.startswith("...")
    assert got[4].text == text[4] and got[4].n_entities == 0
    assert got[5].text is None and got[6].text == "" and got[5].n_entities == 0
    other = {r.doc_id: r.text for r in pii.replace_private(df, secret="another").collect()}
    assert other[1] != a and pii.replace_private(df, "k").where("doc_id = 1").first().text == a


def test_collisions_are_redrawn(spark):
    n = 9000  # nine tenths of all numbers of four digits
    e = spark.range(n).selectExpr("'ssn' as kind", "lpad(cast(id as string), 5, '0') as entity")
    got = pii.entity_surrogates(e, "k").toPandas()
    assert len(got) == n and got.surrogate.is_unique and not set(got.surrogate) & set(got.entity)


def test_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.example.org now")] * 50 + [(None, "ip 1.2.3.4")], "doc_id long, text string")
    got = pii.replace_private(df, "k").collect()
    assert len(got) == 51 and len({r.text for r in got}) == 2 and not any("a.b@c" in r.text or "1.2.3.4" in r.text for r in got)
    assert pii.replace_private(df.limit(0), "k").count() == 0


def test_persons_stay_distinct(spark):
    firsts = [f"{a}{b}" for a in ("Karl", "Emil", "Ole", "Per", "Jan", "Hugo") for b in ("", "a", "bert", "mar", "win", "o", "us")]  # more than are listed
    df = spark.createDataFrame([(i, f"Mr {f} Weber") for i, f in enumerate(firsts)] + [(99, "Mr Karl Weber and Mr Karl Stein and Frau Weber")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace_private(df, "k").collect()}
    assert len({got[i] for i in range(len(firsts))}) == len(firsts)
    new = [got[i].split()[1] for i in range(len(firsts))]
    assert not set(new) & set(firsts) and all(re.fullmatch("[A-Z][a-z]+", n) for n in new)
    a, b, c = re.fullmatch(r"(Mr \w+ \w+) and (Mr \w+ \w+) and Frau (\w+)", got[99]).groups()
    assert a == got[0] and a.split()[1] == b.split()[1] and a.split()[2] == c != b.split()[2]


def test_crowded_shapes_grow(spark):
    names = ["".join(p).title() for p in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=2)]
    df = spark.createDataFrame([(i, f"Mr. {n} is here, so is Frau {n}.") for i, n in enumerate(names)] + [(1000 + i, f"Herr {c}") for i, c in enumerate("Я Ю Э".split())], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace_private(df, "k").collect()}
    new = [re.fullmatch(r"Mr\. (\w+) is here, so is Frau (\w+)\.", got[i]).groups() for i in range(len(names))]
    assert all(a == b for a, b in new) and len({a for a, _ in new}) == len(names) and not {a for a, _ in new} & set(names)
    numbers = spark.range(1000).selectExpr("'phone' as kind", "lpad(cast(id as string), 3, '0') as entity").unionByName(spark.range(10).selectExpr("'ssn' as kind", "cast(id as string) as entity"))
    table = pii.entity_surrogates(numbers, "k").toPandas()
    assert all(part.surrogate.is_unique and not set(part.surrogate) & set(part.entity) for _, part in table.groupby("kind"))


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_check_digits_and_key(spark):
    ibans = ["GB29 NWBK 6016 1331 9268 19", "DE89370400440532013000", "FR14 2004 1010 0505 0001 3M02 606"]
    cards = ["4111 1111 1111 1111", "5500005555555559", "340000000000009"]
    df = spark.createDataFrame([(0, " and ".join(ibans)), (1, " and ".join(cards))], "doc_id long, text string")
    got = {r.doc_id: r.text.split(" and ") for r in pii.replace_private(df, "k").collect()}
    for old, new in zip(ibans, got[0], strict=True):
        plain = new.replace(" ", "")
        assert new != old and new[:2] == old[:2] and [c == " " for c in new] == [c == " " for c in old]
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    for old, new in zip(cards, got[1], strict=True):
        assert new != old and new[0] == old[0] and luhn(re.sub(" ", "", new))
    for key in ("", None):
        with pytest.raises(ValueError, match="key"):
            pii.replace_private(df, key)


# a plain version of the whole replacement, entity by entity


def slow_stream(key, chars):
    return "".join(hashlib.sha256(f"{key}|{b}".encode()).hexdigest() for b in range(len(chars) // 32 + 1))


def slow_redrawn(chars, stream):
    out = ""
    for i, c in enumerate(chars):
        n = int(stream[2 * i : 2 * i + 2], 16)
        low = pii._CYRILLIC if regex.match(r"\p{IsCyrillic}", c) else pii._GREEK if regex.match(r"\p{IsGreek}", c) else "abcdefghijklmnopqrstuvwxyz"
        out += "0123456789"[n % 10] if c in "0123456789" else low[n % len(low)].upper() if regex.match(r"\p{Lu}", c) else low[n % len(low)] if c.isalpha() else c
    return out


def slow_surrogate(kind, entity, secret, attempt):
    more = max(0, attempt - 7)
    stream = slow_stream(f"{secret}|{kind}|{entity}|{attempt}", entity + "x" * more)
    pick = lambda at, n: int(stream[at : at + 4], 16) % n
    if kind == "ip":
        return ".".join(str(pick(4 * i, 254) + 1) for i in range(4))
    if kind == "email":
        body, tld = regex.fullmatch(r"(.*?)(\.\p{L}+)?", entity).groups()
        return slow_redrawn("x" * more + body, stream) + (tld or "")
    if kind == "phone" and entity[0] == "+":
        country, rest = entity.split(" ")
        return country + " " + slow_redrawn(rest + "0" * more, stream)
    if kind == "iban":
        account = slow_redrawn(entity[4:] + "0" * more, stream)
        number = int("".join(str(int(c, 36)) for c in account + entity[:2] + "00"))
        return f"{entity[:2]}{98 - number % 97:02}{account}"
    if kind == "card":
        body = entity[0] + slow_redrawn(entity[1:-1] + "0" * more, stream)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind in ("man", "woman"):
        names = pii.FIRST_NAMES["cyrillic" if regex.search(r"\p{IsCyrillic}", entity) else "latin", kind]
        return "".join(names[pick(4 * i, len(names))] for i in range(min(attempt, 15) + 1)).capitalize()
    tail = "0" if entity[-1] in "0123456789" else "я" if regex.search(r"\p{IsCyrillic}", entity) else "x"
    return slow_redrawn(entity + tail * more, stream)


def slow_parts(kind, m):
    words = m.split(" ")[1:]
    if kind in ("man", "woman"):
        return [(kind, words[0]), ("name", words[1])] if len(words) == 2 else [("name", words[0])]
    digits = re.sub("[^0-9]", "", m)
    if kind in ("phone", "card", "ssn"):
        country = re.match(r"\+(\d{1,3})[ .(-]", m)
        return [(kind, f"+{country[1]} {digits[len(country[1]):]}" if country else digits)]
    return [(kind, m.replace(" ", "") if kind == "iban" else m.lower())]


def slow_written(kind, m, names):
    if kind in ("man", "woman"):
        return " ".join([m.split(" ")[0], *names])
    s = names[0]
    if kind in ("phone", "card", "ssn", "iban"):
        own = "[A-Z0-9]" if kind == "iban" else "[0-9]"
        chars = iter(re.findall(own, s))
        return re.sub(own, lambda _: next(chars), m) + "".join(chars)
    if kind == "email":
        more = len(s) - len(m)
        return s[:more] + "".join(b.upper() if a.isupper() else b for a, b in zip(m, s[more:], strict=True))
    return s


def slow_replacement(texts, secret):
    union = regex.compile(pii._UNION)
    kind = lambda m: next(k for k, p in pii.PATTERNS if regex.fullmatch(p, m) or k == pii.PATTERNS[-1][0])
    found = {m: kind(m) for t in texts if t for m in (x[0] for x in union.finditer(t))}
    known = {e for m, k in found.items() for e in slow_parts(k, m)}
    attempt = dict.fromkeys(known, 0)
    while True:
        drawn = {e: slow_surrogate(*e, secret, n) for e, n in attempt.items()}
        keeper = {}
        for (k, e), new in sorted(drawn.items()):
            keeper.setdefault((k, new), e)
        again = [(k, e) for (k, e), new in drawn.items() if keeper[k, new] != e or (k, new) in known]
        if not again:
            return [t and union.sub(lambda m: slow_written(found[m[0]], m[0], [drawn[e] for e in slow_parts(found[m[0]], m[0])]), t) for t in texts]
        for e in again:
            attempt[e] += 1


def test_replacement_equals_brute_force(spark, sf):
    texts = list(pd.read_parquet(f"{sf}/documents.parquet").text)
    texts += ["Herr Karl Weber, Mrs Ada Weber, Mr Karl Stein", "+49 (30) 1234-5678 or +49 30 1234 5678", "Ann@Ex.example.ORG ann@ex.example.org", "GB29 NWBK 6016 1331 9268 19", "Госпожа Анна Серова и Господин Серов", None, ""]
    texts += [f"Mr {a}{b} met 4111-1111-1111-{i:04}" for i, (a, b) in enumerate(itertools.product("ABCDEFGH", "abcdefghijklmnopqrstuvwxyz"))] + ["same 10.1.2.3"] * 150
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace_private(df, "a key").collect()}
    want = slow_replacement(texts, "a key")
    assert sum(a != b for a, b in zip(texts, want, strict=True)) > 300
    assert [got[i] for i in range(len(texts))] == want
