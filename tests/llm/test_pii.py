import hashlib
import re

from texttrend.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CASES = [
    "a@b.c_d@e.ff x@y.z.w..q@r",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.4 1.2.3 1234567.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 12  34",
    "+1 (555) 555-0100 +12 +1-2-3-4-5-6-7-8-9)",
    None,
    "",
    "é" * 50 + " q@w.ee ü+49 30 1234567",
    "a" * 20_000 + "@" + "b.c" * 200,
    "1" * 20_000,
    "x@y" + ".z" * 5000,
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def by_hand(text):
    spans, counts = [], []
    for kind, pattern in PATTERNS.items():
        count = 0
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if good:
                spans.append(f"{kind}:{m.start()}:{m.end()}")
                count += 1
        counts.append(count)
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        base, spans = by_hand(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == base
        assert set(spans) <= set(r.spans.split(","))  or not spans


def test_base_spans_match_the_patterns(docs_of):
    check(pii.digest(pii.find_personal_data(docs_of(CASES))).collect(), dict(enumerate(CASES)))


def test_given_documents(given):
    check(pii.digest(pii.find_personal_data(given("documents"))).collect(), {r.doc_id: r.text for r in given("documents").collect()})


def mixed(docs_of):
    sure = [f"mail me at user{i}@host{i}.example.com or call +1 (555) 555-{1000 + i} now" for i in range(40)]
    likely = ["call me at (212) 555-0199 today", "write to bob [at] site [dot] com please"]
    doubtful = ["release 212-555-0199x", "serial order 111-555-0199"]
    return docs_of(sure + likely + doubtful + ["plain words only"])


def test_the_method_adds_spans_with_support(docs_of):
    got = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find_personal_data(mixed(docs_of)).collect()}
    assert got[40] == [("phone", False)] and got[41] == [("email", False)]
    assert got[44] == [] and all(len(got[i]) == 2 for i in range(40))


def plain_model(rows, rounds=25):
    """(states by kind, bias, weights) by plain loops over (kind, votes, features)."""
    import math
    from collections import defaultdict

    states, opinions = {}, []
    for kind in sorted({k for k, _, _ in rows}):
        votes = [v for k, v, _ in rows if k == kind]
        prior, r = 0.8, [(0.8, 0.2)] * len(pii.LABELERS)

        def opinion(v):
            odds = prior / (1 - prior)
            for x, (t, f) in zip(v, r):
                odds *= t / f if x == 1 else (1 - t) / (1 - f) if x == -1 else 1
            return odds / (1 + odds)

        for _ in range(rounds):
            weights = [opinion(v) for v in votes]
            prior = min(0.999, (sum(weights) + 4) / (len(votes) + 5))
            r = [
                (
                    (sum(w for v, w in zip(votes, weights) if v[j] == 1) + 8) / (sum(w for v, w in zip(votes, weights) if v[j]) + 10),
                    (sum(1 - w for v, w in zip(votes, weights) if v[j] == 1) + 2) / (sum(1 - w for v, w in zip(votes, weights) if v[j]) + 10),
                )
                for j in range(len(pii.LABELERS))
            ]
        states[kind] = prior, r
        opinions += [(kind, f, opinion(v)) for k, v, f in rows if k == kind]
    yes, no = sum(q for *_, q in opinions), sum(1 - q for *_, q in opinions)
    of_kind, of_feature = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for kind, features, q in opinions:
        of_kind[kind][0] += q
        of_kind[kind][1] += 1 - q
        for f in features:
            of_feature[kind, f][0] += q
            of_feature[kind, f][1] += 1 - q
    weights = {}
    for (kind, f), (a, b) in of_feature.items():
        all_yes, all_no = (yes, no) if f == f"kind={kind}" else of_kind[kind]
        weights[f"kind={kind} {f}"] = math.log((a + 1) / (all_yes + 2)) - math.log((b + 1) / (all_no + 2))
    return states, math.log((yes + 1) / (no + 1)), weights


def test_em_and_span_classifier_agree_with_plain_loops(docs_of):
    import math

    from texttrend.session import store

    docs = docs_of(planted(4, 200)[0] + [r.text for r in mixed(docs_of).collect()])
    found = store(pii.candidates(docs))
    spans = [(r.doc_id, c) for r in found.collect() for c in r.candidates]
    states, bias, weights = plain_model([(c.kind, tuple(c.votes), tuple(c.features)) for _, c in spans])
    got = pii.estimate_reliabilities(found)
    assert got.keys() == states.keys()
    for kind, (prior, r) in states.items():
        assert abs(got[kind][0] - prior) < 1e-9
        assert all(abs(a - c) < 1e-9 and abs(b - d) < 1e-9 for (a, b), (c, d) in zip(got[kind][1], r))
    got_bias, got_weights = pii.train_spans(found, got)
    assert abs(got_bias - bias) < 1e-9 and got_weights.keys() == weights.keys()
    assert all(abs(got_weights[f] - w) < 1e-9 for f, w in weights.items())
    want = set()
    for doc, c in spans:
        odds = bias + sum(weights[f"kind={c.kind} {f}"] for f in c.features)
        if c.base or 1 / (1 + math.exp(-odds)) >= 0.5:
            want.add((doc, c.kind, c.start, c.end))
    assert {(r.doc_id, s.kind, s.start, s.end) for r in pii.find_personal_data(docs).collect() for s in r.spans} == want


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert sorted(str(r.doc_id) for r in pii.find_personal_data(edge_docs).collect()) == sorted(str(r[0]) for r in edge_rows)
    assert pii.find_personal_data(no_docs).count() == 0


def test_no_python_runs(edge_docs):
    plan = pii.candidates(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def planted(seed, docs):
    """(texts, true spans by document): loose forms of personal data in prose, beside decoys of like shape."""
    import random

    draw = random.Random(seed)
    digits = lambda n: "".join(draw.choices("0123456789", k=n))

    def amex():
        body = "37" + digits(12)
        total = sum(d if i % 2 else (2 * d - 9 * (d > 4)) for i, d in enumerate(map(int, body[::-1])))  # the check digit comes behind
        return body + str(-total % 10)

    true = {
        "email": lambda: f"{draw.choice(['contact', 'mail', 'write to'])} anna{digits(2)} [at] {draw.choice(['post', 'site'])}{digits(1)} [dot] {draw.choice(['com', 'org', 'de'])}",
        "ip": lambda: "server 2001:0db8:" + ":".join(f"{draw.randrange(1 << 16):04x}" for _ in range(6)),
        "card": lambda: f"{draw.choice(['card', 'amex', 'payment'])} {amex()}",
        "phone": lambda: f"{draw.choice(['call', 'phone', 'tel'])} {draw.randint(2, 9)}{digits(2)}-{digits(3)}-{digits(4)}",
        "name": lambda: f"{draw.choice(['Dear', 'contact', 'regards'])} Dr. {draw.choice(['Anna', 'Peter', 'Mary', 'Ulrike'])} {draw.choice(['Smith', 'Baker'])}",
    }
    lead = {"email": 2, "name": 1, "phone": 1, "card": 1, "ip": 1}
    decoys = [
        lambda: f"invoice 1{digits(2)}-{digits(3)}-{digits(4)}",
        lambda: f"serial 37{digits(13)}",
        lambda: f"order 0{digits(2)}.{digits(3)}.{digits(4)}",
        lambda: f"release look [at] page{digits(2)} [dot] zzz",
    ]
    texts, spans = [], []
    for i in range(docs):
        text, own = "some plain words here, ", []
        if draw.random() < 0.6:
            kind = draw.choice(list(true))
            phrase = true[kind]()
            words = phrase.split(" ", 2 if phrase.startswith("write to") else lead[kind] if kind != "email" else 1)
            value = words[-1]
            text += phrase
            own.append((kind, len(text) - len(value), len(text)))
        else:
            text += draw.choice(decoys)()
        texts.append(text + " and so on")
        spans.append(own)
    return texts, spans


def test_added_spans_of_planted_examples(docs_of):
    """Precision and recall of what the method adds to the base rules (the README states them)."""
    texts, spans = planted(11, 600)
    found = pii.find_personal_data(docs_of(texts)).collect()
    got = {(r.doc_id, s.kind, s.start, s.end) for r in found for s in r.spans if not s.base}
    want = {(i, *span) for i, own in enumerate(spans) for span in own}
    precision, recall = len(got & want) / max(1, len(got)), len(got & want) / len(want)
    print(f"added spans: precision {precision:.3f}, recall {recall:.3f}, {len(want)} planted, {len(got)} found")
    assert precision > 0.95 and recall > 0.95
