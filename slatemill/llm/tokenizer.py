"""Public tokenizers, by the path of their file; a worker loads each file once."""

from functools import cache

import numpy as np

#: File of the vocabulary in use where no path is given.
DEFAULT = "piece_bpe_32k.model"


def default_path() -> str:
    """Path of the default vocabulary in the installed collection of public tokenizers, a module of the environment; without it a path must be given."""
    try:
        import public_tokenizers
    except ImportError as e:
        raise RuntimeError("no collection of public tokenizers is installed: give the path of a vocabulary file") from e
    return public_tokenizers.path(DEFAULT)


class Pieces:
    """A piece model with byte fallback that loses nothing: the tokens' characters add up to a blank and the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(size)]
        self.width = np.zeros(size, np.int64)
        inner = set()
        for k, name in enumerate(names):
            if self.model.is_byte(k):
                value = int(name[3:5], 16)
                self.width[k] = value < 0x80 or value >= 0xC0
            elif not (self.model.is_control(k) or self.model.is_unknown(k)):
                self.width[k] = len(name)
                inner.update(zip(name.replace("▁", " "), name.replace("▁", " ")[1:]))
        self.index = np.zeros(0x110000, np.int32)
        for k, ch in enumerate(sorted({c for pair in inner for c in pair}), 1):
            self.index[ord(ch)] = k
        self.joined = np.zeros((self.index.max() + 1,) * 2, bool)
        for a, b in inner:
            self.joined[self.index[ord(a)], self.index[ord(b)]] = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []

    def count(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def safe(self, codes: np.ndarray) -> np.ndarray:
        """For each place between two characters whether no token can reach across it (no token holds the two in a row)."""
        at = self.index[codes]
        return ~self.joined[at[:-1], at[1:]]


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)
