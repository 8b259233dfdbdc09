from __future__ import annotations

import random
import re

import pytest
from odd import ODD

from wardmill.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    """The patterns as they are written."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15],
    }


def test_plain_patterns_on_random_text():
    rng = random.Random(6)
    pieces = ["@", ".", "+", "-", " ", "(", "a", "Z", "%", "é", "1", "25", "255", "4111 1111 1111 1111", "1.2.3.4", "a@b.c", "\n", "+49 (30) 123"]
    found = dict.fromkeys(pii.KINDS, 0)
    for _ in range(8000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        base, every = pii.find(text)
        assert base == plain(text), text
        for kind in pii.KINDS:
            found[kind] += len(base[kind])
            assert set(base[kind]) <= set(every[kind])
            assert every[kind] == sorted(every[kind])
            assert all(a[1] <= b[0] for a, b in zip(every[kind], every[kind][1:], strict=False)), text
    assert min(found.values()) > 100


DISGUISED = [
    ("email", "joe [at] host [dot] com"), ("email", "joe(at)host(dot)com"), ("email", "joe at host dot com"),
    ("email", "joe.smith at mail.host.com"), ("email", "joе@host.com"), ("email", "joe＠host．com"),
    ("email", "joe @ host . com"), ("email", "joe&#64;host&#46;com"), ("email", "jo​e7 {at} host.com"),
    ("ip", "97 dot 51 dot 17 dot 173"), ("ip", "192[.]168[.]0[.]1"), ("ip", "１２.3.4.5"),
    ("ip", "one nine two dot one six eight dot zero dot one"),
    ("card", "four one one one " + "one one one one " * 2 + "one one one one"), ("card", "٤111 1111 1111 1111"),
    ("phone", "plus four nine one five one two three four five"), ("phone", "+49 one five one two three four five"),
]


@pytest.mark.parametrize("before", ["", "Nous été: ", "\U0001f600ﬁ is "])
@pytest.mark.parametrize(("kind", "text"), DISGUISED)
def test_disguises_map_back_to_the_source(kind, text, before):
    whole = f"{before}{text}, he said. Meet me at noon dot"
    base, every = pii.find(whole)
    assert [whole[a:b] for a, b in every[kind] if (a, b) not in base[kind]] == [text]
    others = {k: v for k, v in every.items() if k != kind}
    assert others == {k: v for k, v in base.items() if k != kind}


@pytest.mark.parametrize(
    "text",
    ["look at example.com", "three or four of one or two", "the dot. At the end", "a at b. C d at e dot", "[at] (dot)",
     "version 1 dot 2", "room one two three four", "été à l'hôtel ß ½ ²", "un deux trois quatre cinq"],
)
def test_clean_prose_stays_clean(text):
    assert not any(pii.find(text)[1].values())


def test_long_runs_take_time_in_proportion():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000, "+" * 300_000, "a@" * 150_000, "+1" + "(" * 300_000, "one " * 60_000, " at" * 90_000):
        assert pii.find(text)[0] == pii.find(text)[0]


def test_query_columns(documents):
    texts = [*ODD, "a@b.cd é 10.0.0.1", "x [at] y.zz \U0001f600 +49 30 1234567"]
    for r in pii.detect(documents(texts)).collect():
        spans = plain(texts[r.doc_id] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(spans[k]) for k in pii.KINDS]
        assert r.base == ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in spans[k])
    last = pii.detect(documents(texts)).where(f"doc_id = {len(texts) - 1}").first()
    assert last.spans == "email:0:11,phone:14:28"
    docs = documents([(1, "a@b.cd"), (1, "a@b.cd"), (None, None)])
    assert sorted(str(r.text) for r in pii.masked(docs).collect()) == ["<email>", "<email>", "None"]
    assert pii.detect(docs.limit(0)).count() == 0
