import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from proseframe.llm.gru import Trainer, new_net, side_by_side
from proseframe.llm.lm import OTHERS, word_classes, words_of


def test_a_long_text_leaves_no_empty_lanes():
    """Windows are full of words although one text is far longer than the others."""
    rng = np.random.default_rng(4)
    texts = [np.append(rng.integers(1, 72, n), 0) for n in [6000] + [300] * 100]
    trainer = Trainer(new_net(np.arange(100, 30, -1), np.array([5.0, 7.0])))
    seen, _ = trainer.learn([texts], 256)
    assert seen == sum(map(len, texts)) and trainer.steps <= 6001 // 256 + 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=30), st.integers(1, 8), st.integers(1, 50))
def test_texts_lie_whole_in_lanes(sizes, lanes, steps):
    texts = [np.append(np.arange(1, n + 1), 0) for n in sizes]
    read = {i: [] for i in range(len(texts))}
    for inputs, targets, whose, begins in side_by_side(texts, lanes).windows(steps):
        for t in range(len(inputs)):
            for x, y, i, first in zip(inputs[t], targets[t], whose[t], begins[t]):
                if i >= 0:
                    assert first == (not read[i]) and x == (0 if first else read[i][-1])
                    read[i].append(y)
    assert all(read[i] == texts[i].tolist() for i in read)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.one_of(st.sampled_from("aB \t\n\x0b\x0c\r\x1c\x85\xa0\x00é中"), st.characters(exclude_categories=["Cs"])), max_size=20), max_size=8))
def test_words_are_cut_as_bytes_are(texts):
    want = [t.encode().lower().split() if t else [] for t in texts]
    words, sizes = words_of(pa.array(texts, pa.string()))
    assert [w.encode() for w in words.to_pylist()] == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert word_classes(words).tolist() == [zlib.crc32(w[-2:]) % OTHERS for t in want for w in t]
