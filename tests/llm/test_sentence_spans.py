import random

from gradeloom.llm import sentence_spans as ss


def brute(rows):
    seen, out = {}, {}
    texts = {}
    for doc, text in rows:
        texts[-(1 << 63) if doc is None else doc] = text
    for doc in sorted(texts):
        parts = ss.sentences(texts[doc] or "")
        gone = set()
        for first in range(len(parts)):
            for last in range(first + ss.SENTENCES, len(parts) + 1):
                words = tuple(w for p in parts[first:last] for w in p.split())
                if len(words) >= ss.WORDS:
                    if words in seen:
                        gone.update(range(first, last))
                    seen.setdefault(words, doc)
                    break
        kept = "".join(p for i, p in enumerate(parts) if i not in gone)
        out[doc] = (None if texts[doc] is None else kept, len(gone))
    return out


def run(df):
    rows = ss.remove_repeated_sentences(df).collect()
    return {-(1 << 63) if r.doc_id is None else r.doc_id: (r.text, r.n_cut) for r in rows}


def test_parts_are_the_text():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "bc, ", "d. ", "e!\n", "\n\n", "  ", "f?&& "]) for _ in range(rng.randrange(120)))
        assert "".join(ss.sentences(text)) == text


def test_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(900)}"
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(1, 14))) + rng.choice([". ", "! ", ".\n"])
    passages = ["".join(sentence() for _ in range(8)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [sentence() for _ in range(rng.randrange(0, 12))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append((i, "".join(parts)))
    rows += [(60, rows[3][1]), (61, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = run(df)
    assert got == brute(rows)
    assert sum(n > 0 for _, n in got.values()) > 20


def test_a_passage_goes_and_stays_once(spark):
    passage = " ".join(f"p{i}" + ("." if i % 9 == 8 else "") for i in range(63)) + " "
    rows = [(i, f"own{i} words{i} here{i}. {passage}more{i} text{i}.") for i in range(5)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[0] == (rows[0][1], 0)
    assert all("p30" not in got[i][0] and f"own{i}" in got[i][0] for i in range(1, 5))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a. " * 50000), (4, "x" * 300000), (None, "One two. " * 20), (5, "One two. " * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == {}
    twice = ss.remove_repeated_sentences(df.union(df).selectExpr("*", "7 as n_cut", "8 as doc"))
    assert twice.count() == 2 * len(rows) and twice.columns == ["doc_id", "text", "doc", "n_cut"]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = brute(rows)
    for r in ss.op5_sentence_spans(spark, sf).collect():
        assert (r.n_cut, r.n_kept) == (expected[r.doc_id][1], len(expected[r.doc_id][0]))


def cut_second(first, second):
    """Sentences of the second text that stand in no span of the first."""
    known = {s[:2] for s in ss.spans(ss.sentences(first))}
    found = [s for s in ss.spans(ss.sentences(second)) if s[:2] in known]
    return ss.cut(second, [s[2] for s in found], [s[3] for s in found])[0]


def test_a_passage_inside_a_sentence_goes_wherever_it_starts():
    passage = " ".join(f"p{i}x{i * i}" for i in range(60))
    own = lambda n, name: " ".join(f"{name}{i}" for i in range(n))
    for a in range(13):
        for b in range(13):
            second = f"{own(b, 'b')} {passage} {own(9, 'd')}."
            left = cut_second(f"{own(a, 'a')} {passage} {own(9, 'c')}.", second).split()
            assert sum(w[0] == "p" for w in left) <= 36
            assert sum(w[0] == "b" for w in left) == b and left[-1] == "d8."


def test_parts_of_a_long_clause_are_bounded():
    for text in (" ".join(f"w{i}" for i in range(5000)), "same " * 5000):
        parts = ss.sentences(text)
        assert "".join(parts) == text
        assert max(len(p.split()) for p in parts) <= ss.CLAUSE


def test_texts_without_spaces(spark):
    rng = random.Random(3)
    sentence = lambda: "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(rng.randrange(8, 30))) + "。"
    passage = "".join(sentence() for _ in range(40))
    rows = [(i, sentence() + passage + sentence()) for i in range(3)]
    rows += [(5, "謝謝。再見。"), (6, "謝謝。再見。")]
    assert len(ss.sentences(passage)) >= 40 and "".join(ss.sentences(passage)) == passage
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[0] == (rows[0][1], 0)
    for i in (1, 2):
        assert got[i][0] == rows[i][1].replace(passage, "")
    assert got[5][1] == got[6][1] == 0


def test_long_stretches_without_spaces_or_ends():
    rng = random.Random(4)
    signs = lambda n: "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(n))
    passage = signs(300)
    for a, b in ((3, 8), (11, 40)):
        lead = signs(b)
        assert len(cut_second(signs(a) + passage, lead + passage)) < b + 80


def test_ends_of_other_scripts():
    for text in ("یہ ایک ہے۔ دوسرا۔", "एक वाक्य। दूसरा।", "「好。」好！", "هل هذا؟ نعم."):
        assert len(ss.sentences(text)) == 2 and "".join(ss.sentences(text)) == text
