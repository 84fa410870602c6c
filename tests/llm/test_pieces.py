import numpy as np
from tokenizers import Tokenizer

from proseframe.llm.tokens import WordEncoder, tokenizer_path


def test_a_known_piece_is_not_cut_again():
    library = Tokenizer.from_file(tokenizer_path())
    texts = ["Don't go, don't  GO,\tÉté's 42nd!?", " \r\n go, été's\x0b\x0cx ", "", None]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    encoder = WordEncoder(limit=4)
    assert encoder.encode(texts) == want and set(encoder.pieces) == {"don't", "go,", "été's", "42nd!?", "x"}
    encoder.encode([None])
    assert not encoder.pieces and encoder.encode(texts) == want
