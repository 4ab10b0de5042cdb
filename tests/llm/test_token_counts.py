import random

import pyarrow as pa
import pytest
from samples import docs, edge_rows, sentence  # noqa: F401  (docs is a fixture)
from tokenizers import Tokenizer

from tributary.llm import token_counts, words
from tributary.llm.words import Memory, Words

ODD = [
    "a<|endoftext|>b  <|startoftext|>\n<|ENDOFTEXT|>", " x y\x1cz  ́e\x85q é",
    "İstanbul ΣΑΣ ΟΔΟΣ's it'S 'T 12ab3 don't WE'LL", "a\x0bb\x0cc\td", "ﬁ ½ ① ªº µ × ÷ ß ẞ",
    "ÀÉÑ ÿŸ ǅ 北京 한국어 हिन्दी עברית", "!!! ... \"'' --- #$% (x) [y]", "​﻿ zero",
]


@pytest.fixture(scope="module")
def of():
    return Words(token_counts.TOKENIZER)


def test_ids_are_those_of_the_tokenizer(of):
    rng = random.Random(1)
    letters = "aZé'ßÀ9 \n<|_.-Ώ \x1d'sllñ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    for text in [*ODD, *made]:
        ids = of.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(memoryview(of.ids(text)).cast("I")) == ids, text


@pytest.mark.parametrize("together", [1, 50, 4_000_000])
def test_ids_of_many_texts(of, monkeypatch, together):
    monkeypatch.setattr(words, "TOGETHER", together)
    rng = random.Random(3)
    letters = "aZé'ßÀ9 \n<|_.-Ώ \x1d'sllñ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    plain = ["It's plain, IT'S PLAIN!", " two\tlines\nÀÉÑ ", "x" * 300, ""]
    for texts in ([None, *ODD, *made, None, *plain], plain, [None], [""], ODD[:1], []):
        array = pa.array(["cut off", *texts], pa.string())[1:]
        found = [list(memoryview(ids).cast("I")) for ids in of.ids_of_texts(array)]
        assert found == [of.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pretokens_are_given_to_the_model_once(monkeypatch):
    of, asked = words.Words(token_counts.TOKENIZER), []
    monkeypatch.setattr(of.remembered_pretokens, "find", lambda x: asked.append(x) or b"")
    texts = ["Word, word. (WORD) ward", "word; ward's " + "w" * 100, "WORD!"]
    for text in texts * 2:
        list(of.ids_of_texts(pa.array([text])))
    assert [asked.count(x) for x in ("word", "ward", "w" * 100)] == [1, 1, 2]


def test_memory_of_many_is_bounded_and_forgets_the_oldest():
    asked: list[bytes] = []
    memory = Memory(lambda key: asked.append(key) or len(asked), 3)
    assert memory.of_all([b"a", b"b"]) == {b"a": 1, b"b": 2}
    assert memory.of_all([b"c", b"a", b"d"]) == {b"c": 3, b"a": 1, b"d": 4}
    assert memory.of_all([b"b"]) == {b"b": 2}
    assert memory.of_all([bytes([x]) for x in range(9)]) == {bytes([x]): 5 + x for x in range(9)}
    assert len(memory) <= 3
    assert memory.of_all([b"a", b"x" * 100]) == {b"a": 14, b"x" * 100: 15}
    assert b"x" * 100 not in memory


def test_memory_forgets_what_was_not_asked_for_lately():
    asked = []
    memory = Memory(lambda key: asked.append(key) or len(asked), 3)
    for key in (b"a", b"b", b"c", b"d", b"a", b"e", b"f", b"b"):
        memory[key]
    assert asked == [b"a", b"b", b"c", b"d", b"e", b"f", b"b"]
    assert len(memory) <= 3


@pytest.mark.parametrize("head", [0, 7, 100_000])
def test_counts(docs, monkeypatch, head):
    """Whatever share of the vocabulary goes to every task."""
    monkeypatch.setattr(token_counts, "GATHER", 50)
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randint(0, 60)), "en", "a", 1) for i in range(80)]
    rows += [(1000 + i, text, "en", "a", 1) for i, text in enumerate(ODD)]
    rows += edge_rows()
    out = token_counts.token_counts(docs(rows, clash=True), head=head).collect()
    tokenizer = Tokenizer.from_file(token_counts.TOKENIZER)
    wanted = [
        (str(row[0]), len((row[1] or "").encode()),
         len(tokenizer.encode(row[1] or "", add_special_tokens=False).ids))
        for row in rows
    ]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == sorted(wanted)


def test_the_head_is_bounded_and_takes_the_most_frequent(spark):
    known = spark.range(1000).selectExpr(
        "cast(id as string) as pretoken", "1000 - id as frequency", "1L as pieces"
    )
    for most in (0, 1, 10, 500, 5000):
        head = [int(r.pretoken) for r in token_counts.frequent(known, most).collect()]
        assert len(head) <= most
        assert sorted(head) == list(range(len(head)))
    assert len(head) == 1000


def test_each_pretoken_is_counted_once(docs):
    known = token_counts.vocabulary(docs([(1, "the THE the, cat's", "", "", 1)] * 3)).collect()
    assert {r.pretoken: r.frequency for r in known} == {"the": 9, ",": 3, "cat": 3, "'s": 3}
    assert token_counts.token_counts(docs([])).count() == 0
