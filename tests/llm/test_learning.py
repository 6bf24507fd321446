"""How the encoder learns pieces it has not met: in one call for many, without the library's character offsets."""

import public_tokenizers
import pyarrow as pa
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import Split

from gaugeline.llm import byte_bpe
from gaugeline.llm.queries import RANKS, TOKENIZER

TEXTS = [" ".join(f"wört{i}le größer{i % 7}, naïve{i}. 東京{i}\n\tx" for i in range(300)), "", None, " a  b c d e　", "<|endoftext|> tail <|endoftext|>", "🙂🙃 🙂 é "]


class WithoutOffsets:
    """A tokenizer that refuses the walk that keeps offsets."""

    def __init__(self, tokenizer):
        self.__dict__["of"] = tokenizer

    def __getattr__(self, name):
        assert name != "encode", "offsets are not needed"
        return getattr(self.of, name)

    def __setattr__(self, name, value):
        setattr(self.of, name, value)


def check(tokenizer, encoder):
    for _ in range(2):
        ids, at = encoder.encode(pa.array(TEXTS))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_pieces_are_learned_without_offsets():
    for made in (lambda: Tokenizer.from_file(TOKENIZER), lambda: byte_bpe.tokenizer_from_ranks(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)):
        plain = made()
        plain.encode_special_tokens = True
        check(plain, byte_bpe.Encoder(WithoutOffsets(made())))


def test_a_vocabulary_of_characters_is_learned_piece_by_piece():
    letters = sorted({c for t in TEXTS for c in t or ""})
    made = Tokenizer(BPE(vocab={c: i for i, c in enumerate(letters)}, merges=[]))
    made.pre_tokenizer = Split(Regex(public_tokenizers.PATTERN), "isolated")
    check(made, byte_bpe.Encoder(made))
