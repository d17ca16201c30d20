import math
import random

import numpy as np

from raregrain.llm import langid as li

from .fixtures import awkward_rows, documents

SYLLABLES = {"en": ["the", "ing", "and", "er"], "de": ["sch", "ein", "ung", "zu"], "fr": ["eau", "oui", "ment", "é"]}
PATH = li.piece_path()


def text(rng, lang, n=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark, n=150):
    rng = random.Random(1)
    rows = [(i, lang := rng.choice(sorted(SYLLABLES)), text(rng, lang)) for i in range(n)]
    return rows, spark.createDataFrame([(i, t, g, "s", len(t)) for i, g, t in rows],
                                       "doc_id bigint, text string, lang string, source string, n_chars bigint")


def by_recursion(word, probs, pieces):
    """Sum over all segmentations, written out."""
    marked = "▁" + word

    def total(at):
        if at == len(marked):
            return 1.0
        out = li.UNKNOWN * total(at + 1)
        for n in range(1, len(marked) - at + 1):
            i = pieces.get(marked[at:at + n])
            if i is not None:
                out += probs[i] * total(at + n)
        return out
    return math.log(total(0))


def piece_ids():
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    names = sorted({m.id_to_piece(i).lower() for i in range(m.get_piece_size())
                    if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))})
    return {p: i for i, p in enumerate(names)}


def test_forward_sums_all_segmentations():
    voc, rng = li.vocabulary(PATH), np.random.default_rng(0)
    probs = rng.random((voc.size, 2))
    probs /= probs.sum(axis=0)
    words = ["the", "ingand", "schule", "é", "日本", "zxqj", "a"]
    got = li.word_scores(words, voc, probs)
    for i, w in enumerate(words):
        for g in range(2):
            assert math.isclose(got[i, g], by_recursion(w, probs[:, g], piece_ids()), rel_tol=1e-9)


def test_expected_counts_are_the_derivative_of_the_score():
    voc, rng = li.vocabulary(PATH), np.random.default_rng(1)
    probs = rng.random(voc.size)
    probs /= probs.sum()
    counts = li.expected_counts(["theing"], np.array([3.0]), voc, probs)
    piece = int(counts.argmax())
    moved = probs.copy()
    moved[piece] *= 1 + 1e-6
    score = [li.word_scores(["theing"], voc, p[:, None])[0, 0] for p in (probs, moved)]
    assert math.isclose(3 * (score[1] - score[0]) / 1e-6, counts[piece], rel_tol=1e-3)


def test_held_out_documents_are_recognised(spark):
    rows, df = corpus(spark)
    names, probs = li.fit(df.where(~li.held_out()), PATH)
    assert names == sorted(SYLLABLES) and np.allclose(probs.sum(axis=0), 1.0)
    out = {r.doc_id: r for r in li.predict(df.withColumn("lang_pred", df.lang), PATH, names, probs).collect()}
    assert sum(out[i].lang_pred == g for i, g, _ in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_labels_of_held_out_documents_change_nothing(spark):
    _, df = corpus(spark, 60)
    other = df.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 "
                                            "THEN 'xx' ELSE lang END AS lang", "source", "n_chars")
    a, b = (li.fit(x.where(~li.held_out()), PATH) for x in (df, other))
    assert a[0] == b[0] and np.allclose(a[1], b[1])


def test_sample_is_bounded_by_its_parameter(spark):
    _, df = corpus(spark, 150)
    small = li.fit(df, PATH, sample=10)
    assert small[0] == sorted(SYLLABLES) and not np.allclose(small[1], li.fit(df, PATH)[1])


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(li, "CACHE", 40)
    _, df = corpus(spark, 60)
    names, probs = li.fit(df, PATH)
    rows = awkward_rows() + [(90, "123 !? 456"), (91, text(random.Random(2), "de")), (92, "y" * 200)]
    out = li.predict(documents(spark, rows, clashes=True), PATH, names, probs).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == (li.UNDECIDED, 0.0)
        else:
            assert r.lang_pred in names
    assert next(r.lang_pred for r in out if r.doc_id == 91) == "de"


def test_no_labels_and_empty_table(spark):
    unlabelled = documents(spark, [(1, "the")]).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    names, probs = li.fit(unlabelled, PATH)
    assert names == [] and li.predict(unlabelled, PATH, names, probs).first().lang_pred == li.UNDECIDED
    assert li.predict(documents(spark, []), PATH, names, probs).count() == 0


def test_held_out_remainder(spark):
    import zlib
    got = {r.id: r.h for r in spark.range(50).select("id", li.held_out("id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}
