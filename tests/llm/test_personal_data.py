import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from trackloom.llm import personal_data as P

PLAIN = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == 3 and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@given(st.text(alphabet="a0129.@-+ ()_é", max_size=60))
def test_fixed_forms_match_the_plain_patterns(text):
    assert P.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["4111 1111-1111 1111", "a@b.c_x@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.255", "+1 (222) 555-0100 +1 222", "x@@y.z", "0000.1.2.3 99999999999999.1.1.1"])
def test_known_cases(text):
    assert P.base_spans(text) == brute(text)


def test_long_runs_are_linear():
    assert P.base_spans("a" * 300_000 + " 1" * 100_000 + "." * 100_000 + "@" * 100_000) is not None


def corpus(r, n=300):
    out = []
    for _ in range(n):
        phone, card = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}", "4111111111111111"
        parts = [r.choice(["call", "see", "page 12", "year 1999", "room 7b", "v1.2"]), r.choice([phone, card, "bob.7@mail.example.com", "10.20.30.40", "x"])]
        out.append(" ".join(["the word"] * r.randint(1, 5) + parts + ["and so on"]))
    return out


def test_repeats_take_over_the_label():
    """A mention without its plus is no fixed form; the field adds it, and with it a clear mention far away."""
    weights = P.fit(corpus(random.Random(0)))
    text = "write to +1 (222) 555-0100 now. Later: (222) 555-0100 again, page 12 of 1999"
    (spans,) = P.all_spans([text], weights)
    base = brute(text)
    assert set(base) <= set(spans)
    assert [(text[s:e], k) for s, k, e in spans if (s, k, e) not in base] == [("(222) 555-0100", 3)]
    assert P.all_spans(["write to a friend now. Later: 2225550100 again, page 12 of 1999"], weights) == [[]]
    field = P.Field([text])
    p, apart = P.marginals(field, weights), P.Field([text])
    apart.edges = [e for e in apart.edges if e[2] == 0]
    q = P.marginals(apart, weights)
    second = [i for i in range(field.n) if text[field.starts[i] : field.ends[i]] == "555-0100"][1]
    assert p[second, 3] > q[second, 3]


@pytest.mark.parametrize("clear", [0, 25, 49])
def test_fifty_mentions_and_one_clear_form(clear):
    """Wherever the clear one stands, all mentions take its label."""
    weights = P.fit(corpus(random.Random(0)))
    text = " some words between, ".join("+12225550100" if k == clear else "2225550100" for k in range(50))
    (spans,) = P.all_spans([text], weights)
    assert [(text[s:e].lstrip("+"), k) for s, k, e in spans] == [("12225550100" if k == clear else "2225550100", 3) for k in range(50)]


def test_recall_on_planted_repeats():
    """Of planted repeats of phones, cards and addresses in other spellings most are found, and nothing in texts without a clear form."""
    r = random.Random(5)
    weights, found, planted, wrong = P.fit(corpus(r)), 0, 0, 0
    for _ in range(200):
        a, b = f"{r.randint(200, 999)}", f"{r.randint(200, 999)}-{r.randint(1000, 9999)}"
        clear, again = f"+1{a}{b.replace('-', '')}", r.choice([f"{a}{b.replace('-', '')}", f"{a}-{b}", f"{a}.{b.replace('-', '.')}"])
        filler = lambda: " ".join(r.choice(["the", "word", "page 12", "year 1999", "v1.2", "and", "so"]) for _ in range(r.randint(3, 30)))
        n = r.randint(1, 6)
        parts = [again] * n
        parts.insert(r.randint(0, n), clear)
        text = " ".join(f"{filler()} {x}" for x in parts)
        (spans,) = P.all_spans([text], weights)
        new = [text[s:e] for s, k, e in spans if (s, k, e) not in brute(text)]
        planted, found, wrong = planted + n, found + new.count(again), wrong + sum(x != again for x in new)
        wrong += len(P.all_spans([" ".join(filler() for _ in range(5))], weights)[0])
    assert found >= 0.9 * planted and wrong <= 0.02 * planted


def test_many_spans_in_one_text_stay_linear():
    weights = P.fit(corpus(random.Random(0)))
    text = "call +12225550100 or 2225550100 on page 12, " * 4000
    (spans,) = P.all_spans([text], weights)
    assert len(spans) == 8000


def test_marginals_are_exact_on_chains():
    weights = P.Weights(np.random.default_rng(0).normal(size=(P.N_FEATURES, P.LABELS)), np.random.default_rng(1).normal(size=(2, P.LABELS, P.LABELS)))
    field = P.Field(["1a 22b 333c"])
    u = field.unary(weights.unary)
    t = weights.pairs[0]
    joint = np.exp(u[0][:, None, None] + u[1][None, :, None] + u[2][None, None, :] + t[:, :, None] + t[None])
    joint /= joint.sum()
    got = P.marginals(field, weights, settled=0.0)
    assert np.allclose(got, [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))], atol=1e-6)


def test_table(spark):
    data = [(k, t) for k, t in enumerate(corpus(random.Random(1), 60))] + [(100, None), (101, ""), (0, "bob@x.yz")]
    df = spark.createDataFrame([(*d, "clash") for d in data], "doc_id long, text string, spans string")
    out = P.find_personal_data(df, P.train(df))
    assert sorted((r.doc_id, r.base) for r in out.collect()) == sorted((k, P.listed(brute(t or ""))) for k, t in data)
    assert all(set(filter(None, r.base.split(","))) <= set(r.spans.split(",")) for r in out.collect())
    assert P.find_personal_data(df.limit(0), P.train(df.limit(0))).collect() == []
