"""Ids of texts that are cut into pieces are those of the whole texts."""

import random

import numpy as np

from samplecraft.llm.queries import tokenizer_path
from samplecraft.llm.token_files import END_ID, Encoder


def test_words_are_kept_without_their_punctuation():
    encoder = Encoder(tokenizer_path(), END_ID)
    encoder.encode(["see foo, foo. foo; (foo) foo's foo", "see foo! Foo-foo foo"])
    assert set(encoder.known) == {b" foo", b",", b".", b";", b" (foo", b")", b"'s", b"!", b" Foo", b"-foo"}


def test_pieces_give_the_ids_of_whole_texts():
    marks = ["don't", "we'LL", "'s", "''re", "x'd,", "a1b2", "3.14", "foo,bar", "...", "(a)", "é,", "é.", "ünï-co", "東京,", "a b", "\n", "\t.", "  ", " ", "<|endoftext|>", "x<|endoftext|>,y", "<|endoftext", "|>", "_a_", "$x", "\U0001f600!"]
    pick = random.Random(7)
    texts = ["".join(pick.choice(marks) + pick.choice(["", " ", " ", ","]) for _ in range(pick.randrange(12))) for _ in range(3000)]
    whole = Encoder(tokenizer_path(), END_ID).tokenizer
    want = [[*whole.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
    for kept in (0, 40, 1_000_000):
        encoder, got = Encoder(tokenizer_path(), END_ID, kept), []
        for k in range(0, len(texts), 100):
            got += [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts[k : k + 100])]
        assert got == want and len(encoder.known) <= kept
