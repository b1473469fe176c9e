import numpy as np
import pyarrow as pa
import public_tokenizers as P
from fareweave.llm import bpe, library, words
from tokenizers import Tokenizer

PATH = P.path("byte_bpe_50k.json")


def numbers(learned):
    """A cache whose pieces are numbers; the ids of one are its length and itself."""

    def learn(pieces):
        learned.extend(pieces)
        return [np.array([len(p), int(p)], np.int32).tobytes() for p in pieces]

    return words.PieceIds(learn, np.int32)


def test_a_piece_is_encoded_once_among_many():
    learned = []
    cache = numbers(learned)
    for first in range(0, 320_000, 80_000):
        texts = [["7", str(i % 60_000 + 100_000), str(i + 200_000)] for i in range(first, first + 80_000)]
        offsets, ids = words.join_ids(pa.array([*texts, [], None], pa.list_(pa.string())), cache)
        assert offsets.tolist() == [*range(0, 480_001, 6), 480_000, 480_000]
        assert ids.reshape(-1, 2).tolist() == [[len(p), int(p)] for t in texts for p in t]
    assert len(learned) == len(set(learned))


def test_pieces_beyond_the_bound_are_forgotten(monkeypatch):
    monkeypatch.setattr(words, "PACKED_PIECES", 3)
    learned = []
    cache = numbers(learned)
    for texts in ([["1", "22", "1"], ["3", "44"]], [["22", "5"]], [["22"]]):
        offsets, ids = words.join_ids(pa.array(texts, pa.list_(pa.string())), cache)
        assert ids.reshape(-1, 2).tolist() == [[len(p), int(p)] for t in texts for p in t]
        assert offsets[-1] == len(ids)
    assert learned == ["1", "22", "3", "44", "22", "5"]


def test_split_pieces_as_the_library():
    coder, whole = library.LibraryTokenizer(PATH), Tokenizer.from_file(PATH)
    every = "".join(map(chr, range(0x500))) + "\U0001f468\u200d\U0001f469 \u65e5\u672c\u3000 \x85\u2028 x"
    texts = ["it's we'll\n\n  <|endoftext|>x <|endoftext|>", every, " ".join(every), "aab" * 500, "<|endoftext|", " \t \r\n"]
    for text in texts:
        ids = np.frombuffer(b"".join(coder.encode_pieces(coder.split(text))), coder.dtype).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


def test_both_tokenizers_encode_a_piece_once_in_a_task():
    ranked = bpe.RankTokenizer(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    for coder in (ranked, library.LibraryTokenizer(PATH)):
        learned = []
        coder.cache.learn = lambda pieces, learned=learned: learned.extend(pieces) or [b""] * len(pieces)
        for first in (1000, 101_000, 201_000):
            words.join_ids(pa.array([[" often", *map(str, range(first, first + 100_000))]], pa.list_(pa.string())), coder.cache)
        assert len(learned) == 300_001
        coder.forget()
        words.join_ids(pa.array([[" often"]], pa.list_(pa.string())), coder.cache)
        assert learned[300_001:] == [" often"]
