import public_tokenizers

from lumbre.llm import bpe_trie


def test_steps_of_last_letters_are_bounded_too(monkeypatch):
    """Words of one letter have no other step than that of their end."""
    monkeypatch.setattr(bpe_trie, "STEPS", 3)
    mine = bpe_trie.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    list(mine.batch(["a b c d e f g"]))
    assert len(mine.bpe.steps) <= 3
