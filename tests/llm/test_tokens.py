import random
import struct

import public_tokenizers
from tokenizers import Tokenizer

from carestar.llm.token_counts import count_tokens, with_limit
from carestar.llm.wordbpe import Encoder, whole_tokens
from tests.llm.cases import edge_rows, empty, frame

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library_for_any_characters():
    encoder = Encoder(PATH, whole_tokens(PATH))
    rng = random.Random(3)
    letters = "aAbZé É'’stTl0 9_!.<|>\n\tßÿ́ı\x1f\x1c#İΣ日😀\xa0 "
    texts = ["", "a<|endoftext|>b <|ENDOFTEXT|>", "don't'll'S !'s _!_", " ̈a", "ΑΣ ΣΣ"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    for text in texts:
        packed = encoder.ids(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library_ids(text), repr(text)
        assert encoder.count(text) == len(library_ids(text))


def test_whole_tokens_are_single():
    whole = whole_tokens(PATH)
    assert len(whole) > 20_000
    sample = random.Random(1).sample(sorted(whole), 500)
    assert all(library_ids(text) == [whole[text]] for text in sample)


def test_counts_of_edge_rows(spark):
    got = with_limit(count_tokens(frame(spark), PATH), 100).collect()
    want = [
        (i, len((t or "").encode()), n := len(library_ids(t or "")), n > 100) for i, t in edge_rows()
    ]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(spark):
    assert count_tokens(empty(spark), PATH).collect() == []
