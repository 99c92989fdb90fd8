import hashlib

import numpy as np

from texttrend.llm import fingerprint as fp


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_likeness_follows_the_true_similarity():
    random = np.random.default_rng(2)
    errors = []
    for share in np.linspace(0, 1, 41):
        words = [f"w{random.integers(1 << 40)}" for _ in range(600)]
        cut = int(share * 600)
        other = words[:cut] + [f"v{random.integers(1 << 40)}" for _ in range(600 - cut)]
        a, b = " ".join(words), " ".join(other)
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        errors.append(fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) - true)
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.1 and abs(np.mean(errors)) < 0.02


def test_densified_bins_keep_equality_for_short_texts():
    errors = []
    for n in range(8, 80, 3):
        a = " ".join(f"a{i}" for i in range(n))
        b = a + " " + " ".join(f"b{i}" for i in range(n // 3))
        true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        errors.append(fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) - true)
    assert abs(np.mean(errors)) < 0.08 and np.abs(errors).max() < 0.3
    least = fp.bin_minima("just a few words here and there")
    assert (least == fp.EMPTY).any() and not (fp.densified(least) == fp.EMPTY).any()


def test_bins_are_filled_one_attempt_after_the_other():
    """The tables of attempts give what trying them singly gives."""
    for text in ("one", "a b c d e f", " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(9000))):
        least = fp.bin_minima(text)
        want = least.copy()
        for at in np.nonzero(least == fp.EMPTY)[0].tolist():
            attempt, value = 1, fp.EMPTY
            while value == fp.EMPTY:
                mixed = fp._mixed(np.array([(at * int(fp.MIX) + attempt * int(fp.STEP)) & (2**64 - 1)], np.uint64))
                value, attempt = least[int(mixed[0]) % len(least)], attempt + 1
            want[at] = value
        assert (fp.densified(least) == want).all()


def test_small_texts():
    assert fp.fingerprint(None) == fp.fingerprint(" \n") == b""
    assert fp.likeness(b"", b"") == 1.0 and fp.likeness(b"", fp.fingerprint("a")) == 0.0
    assert fp.fingerprint("One two") == fp.fingerprint("one  TWO\n") != fp.fingerprint("two one")
    assert len(fp.fingerprint("a")) == fp.BINS * fp.KEPT // 8


def by_hand(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, r in enumerate(ordered):
        text, following = r[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        changed = fp.edited(text, following)
        a, b, c = map(fp.fingerprint, (text, changed, following))
        out.append((r[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(), fp.likeness(a, b), fp.likeness(a, c)))
    return out


def test_edge_rows_over_many_runs(edge_docs, edge_rows, no_docs):
    want = sorted(by_hand(edge_rows), key=str)
    for size in (1 << 24, 20_000, 300):
        assert sorted(map(tuple, fp.digest(fp.beside_next(edge_docs, run_bytes=size)).collect()), key=str) == want
    assert fp.beside_next(no_docs).count() == 0
    one = edge_docs.where("doc_id = 6")
    assert fp.beside_next(one).first().near_next == 1.0


def test_given_documents(given):
    rows = [(r.doc_id, r.text) for r in given("documents").collect()]
    assert sorted(map(tuple, fp.digest(fp.beside_next(given("documents"), run_bytes=1 << 16)).collect())) == sorted(by_hand(rows))


def test_column_form(edge_docs):
    assert {bytes(r.p) for r in fp.with_fingerprint(edge_docs.where("doc_id in (1, 11)"), name="p").collect()} == {fp.fingerprint(edge_docs.first().text)}
