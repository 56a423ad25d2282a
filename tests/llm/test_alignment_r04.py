"""What is compared for every id."""

from textmill.llm import token_alignment
from textmill.llm.queries import vocabulary


def test_bytes_of_a_piece_are_compared_once(monkeypatch):
    tokenizers = token_alignment.Tokenizers(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))

    class Watched(list):
        read = 0

        def __getitem__(self, i):
            Watched.read += 1
            return list.__getitem__(self, i)

    tokenizers._bytes = Watched(tokenizers._bytes[0]), tokenizers._bytes[1]
    ids, ends = tokenizers.tokens(" some plain words some plain words")
    assert ends[0][-1] == ends[1][-1] == 34 and Watched.read == 0
    # an id whose bytes differ is found, whether its piece is new or known
    wrong = int(ids[0][1])
    for known in (False, True):
        one = token_alignment.Tokenizers(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
        table = one._bytes[0]
        table[wrong] = b"?"
        for _ in range(1 + known):
            assert one.tokens(" some plain words") is None
        assert one.tokens(" words") is not None
