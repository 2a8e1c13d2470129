import random

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import moderation as M

# Templates of these tests' own.
CLEAN = ["The ferry to {} leaves at nine.", "We counted the votes in {} twice.", "Please mow the lawn behind {} soon.", "What a rotten old pump they have in {}.", "The rats in the barn of {} ate the seed.", "Nobody in {} likes the new roof."]
BAD = ["You rotten {w}, leave {} alone.", "Every {w} from {} ought to be whipped.", "Take off your blouse for me, {}.", "I hope the {w}s of {} starve.", "Only a {w} would live in {}."]
WORDS = ["wretch", "blockhead", "swine", "guttersnipe"]
PLACES = [f"Place{i}" for i in range(40)]


def corpus(n, seed, words=WORDS):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.2
        lines = [rng.choice(CLEAN).format(rng.choice(PLACES)) for _ in range(rng.randint(2, 6))]
        if bad:
            lines.insert(rng.randint(0, len(lines)), rng.choice(BAD).format(rng.choice(PLACES), w=rng.choice(words)))
        out.append((" ".join(lines), bad))
    return out


def fitted(seed=1):
    rng = random.Random(5)
    return M.fit([(t, float(bad) if rng.random() > 0.05 else 1 - float(bad)) for t, bad in corpus(800, seed)])


def test_held_out_accuracy_with_erring_readers():
    scorer = M.Scorer(fitted())
    for words in (WORDS, ["ogre", "ghoul"]):  # words of abuse that no label shows, too
        docs = corpus(400, 2, words)
        hit = scorer.scores([t for t, _ in docs]) >= 0
        bad = np.array([b for _, b in docs])
        assert (hit & bad).sum() / bad.sum() > (0.95 if words is WORDS else 0.6)
        assert (hit & bad).sum() / hit.sum() > 0.95


def read(text, words):
    reader = M.Reader(words)
    at, _, _ = reader.items_of([text])
    return [reader.plain[i] for i in at]


def test_disguises():
    words = M.Vocabulary.of({"wretch": 9, "swine": 9, "filthy": 3}, {"the": 50, "you": 50}, ["the", "you", "a", "closer"], 0.2)
    for text in ("you w.r.e.t.c.h", "you w r e t c h.", "you wr3tch", "you wre​tch", "you wrеtch", "you wr*tch", "you wr#tch", "you wrrrretch", "YOU WRETCH", "you WRETCH", "you w-r-e-t-c-h!", "you wr@tch", "you a w r e t c h"):
        assert read(text, words)[-1] == "wretch", (text, read(text, words))
    assert read("they are s***e", words)[-1] == "swine"
    assert read("report #123 of $1,258.56", words) == ["report", "0", "of", "0"]
    assert read("the afilthyswine and a closer alligator", words) == ["the", "a", "filthy", "swine", "and", "a", "closer", "alligator"]


def test_names_and_segments():
    reader = M.Reader(M.Vocabulary.of({}, {}, ["the", "report", "is", "late", "see", "thank", "you"], 1.0))
    h, segment, document = reader.read(["The report is late. Thank you\nsee Anna Lee", "", None, "late  late"])
    assert segment.tolist() == [0, 0, 0, 0, 1, 1, 2, 2, 2, 3, 4] and document.tolist() == [0, 0, 0, 3, 3]
    assert h[7] == h[8] != h[0]
    same, _, _ = reader.read(["the report is late"])
    assert (h[:4] == same).all()


def test_no_labels_and_odd_texts():
    for labelled in ([], [("fine", 0.0)], [("you wretch", 1.0)], [(None, 1.0), ("", 0.0)], [("x", 0.5)], [("...", 1.0), ("--", 0.0)]):
        assert M.fit(labelled) is None
    scorer = M.Scorer(fitted())
    got = scorer.scores(["a" * 200_000 + " " + "b c " * 20_000, None, "", "  \n ", "...", "\x00 x", "You rotten wretch, leave Place1 alone."])
    assert np.isneginf(got[1:5]).all() and np.isfinite(got[[0, 5]]).all() and got[6] > 0
    assert len(scorer.scores([])) == 0


def test_every_document_gets_a_score(spark):
    many = corpus(300, 3)
    docs = [(i, t, "s", 0.1, "x") for i, (t, _) in enumerate(many)] + [(900, None, "s", 0.1, "x"), (901, "", None, 0.1, "x"), (902, "  \n", "s", 0.1, "x"), (900, "Only a swine would live in Place3.", "s", 0.1, "x")]
    labels = [(i, "r", int(b)) for i, (_, b) in enumerate(many)] + [(5, "q", None), (7777, "q", 1)]
    d = spark.createDataFrame(docs, "doc_id int, text string, source string, score double, label string")
    lab = spark.createDataFrame(labels, "doc_id int, reader string, label int")
    got = M.moderated(d, lab, keep=("source",))
    assert got.columns == ["doc_id", "source", "score"] and got.count() == len(docs)
    blank = {r.score for r in got.filter("doc_id IN (901, 902)").collect()}
    assert blank == {0.0}
    assert got.filter((F.col("doc_id") == 900) & (F.col("score") > 0.5)).count() == 1
    assert M.moderated(d.limit(0), lab.limit(0)).count() == 0
    assert {r.score for r in M.moderated(d, lab.limit(0)).collect()} == {0.0}
    assert 9 <= M.labelled_sample(d, lab, sample=10).count() <= 10  # one label has no document
