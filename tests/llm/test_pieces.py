import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import brute
from ferry.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces.load(PATH)


@pytest.fixture(scope="module")
def library():
    """The model with its type set to unigram (field 3 of the trainer's settings: 2 to 1), so that the library looks for the best path too."""
    raw = open(PATH, "rb").read()
    at = raw.rindex(b"\x06tok_v0\x18\x02") + 8
    return sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x01" + raw[at + 1 :])


def test_against_the_library(model, library):
    rng = random.Random(4)
    for text in ["the cat", "Anblewh sttible", "über die Straße", "x1y2", "😀漢é", "internationalisation"] + ["".join(rng.choices("aeinrst", k=9)) for _ in range(60)]:
        (best, *_) = library.nbest_encode(text, nbest_size=2, out_type=str)
        assert [model.texts[i] for i in model.encode(text).tolist() if model.texts[i]] == [p for p in best if not p.startswith("<0x")]


def test_best_sum_against_every_cut(model):
    scores = {t: model.automaton.get(t)[1] for t in model.texts if t}
    rng = random.Random(6)
    for text in ["".join(rng.choices("▁aeinrsthou", k=rng.randrange(1, 25))) for _ in range(60)]:
        ids = model.best(text)
        assert "".join(model.texts[i] for i in ids) == text
        assert sum(scores[model.texts[i]] for i in ids) == brute.best_path(text, scores, model.lowest)


def test_parts_give_the_best_of_the_whole(model):
    for text in ("a  b\n\nc   d ", " lead", "one two\nthree   four\n", "x\ny"):
        assert model.encode(text).tolist() == model.best("▁" + text.replace(" ", "▁"))


def test_round_trip(spark, model):
    texts = brute.TEXTS + ["a▁b", "\n\n", "  two  ", "\x00\x01�", "🧑‍🚀", "<s></s><0x41>"]
    for text in texts:
        assert model.decode(model.encode(text or "")) == (text or "").replace("▁", " ")
    docs = brute.documents(spark, texts)
    assert all(r.round_trip for r in pieces.piece_report(docs, PATH).collect())
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encoded(docs, PATH), PATH).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert pieces.piece_report(brute.documents(spark, []), PATH).count() == 0
    assert pieces.piece_report(brute.documents(spark, ["a", "a"], ids=[None, None]), PATH).count() == 2


def test_vocabulary_without_bytes_and_with_blanks_inside():
    own = pieces.Pieces([("", 0.0), ("▁a", -1.0), ("a▁b", -1.5), ("▁", -2.0), ("b", -2.0), ("a", -2.0), ("▁a▁b", -1.2)], {}, 0)
    assert own.encode("a b").tolist() == [6]
    assert own.encode("a?b").tolist() == [1, 0, 4] and own.decode(own.encode("a?b")) == "a ⁇ b"


def test_decoding_as_the_library_does(model):
    """Ids that begin anywhere, control ids, the unknown one, and bytes that are cut."""
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert model.decode(np.array([own.piece_to_id(p) for p in ("a", "b", "c")])) == "abc"
    ids = model.encode("the cat sat  on 漢 two").tolist()
    rng = random.Random(1)
    for _ in range(200):
        a = rng.randrange(len(ids))
        some = ids[a : rng.randrange(a, len(ids) + 1)]
        for extra in (0, 1, 2):
            if rng.random() < 0.2:
                some.insert(rng.randrange(len(some) + 1), extra)
        if not any(model.bytes_of.get(i, 0) >= 128 for i in some):  # the library writes one mark for each byte that is cut off
            assert model.decode(np.array(some, np.uint32)) == own.decode(some), some


def test_models_that_change_texts_are_refused(tmp_path):
    raw = open(PATH, "rb").read()
    at = raw.rindex(b"identity")
    other = tmp_path / "other.model"
    other.write_bytes(raw[:at] + b"nmt_nfkc" + raw[at + 8 :])
    try:
        changed = sentencepiece.SentencePieceProcessor(model_file=str(other)).normalize("ﬁ")
    except Exception:
        pytest.skip("the library does not load it")
    if changed != "▁ﬁ":
        with pytest.raises(ValueError, match="identity"):
            pieces.Pieces.load(str(other))


def test_what_is_kept_changes_nothing(model):
    small = pieces.Pieces.load(PATH)
    small.most = 3
    for text in ("one two three four one two five six seven one", "a b c d e f g h a b"):
        assert small.encode(text).tolist() == model.encode(text).tolist()
