from viewtide.llm import base, language, tokens
from viewtide.llm.queries import TOKENIZER


def test_one_thing_is_kept():
    """What a worker made for one stage goes when another stage, or other input, needs something else."""
    base.KEPT.clear()
    english = (("en", "the cat sat on the mat"),)
    model = language._model(english)
    assert language._model(english) is model and len(base.KEPT) == 1
    tokenizer = tokens.word_tokenizer(TOKENIZER)
    assert tokens.word_tokenizer(TOKENIZER) is tokenizer and list(base.KEPT.values()) == [tokenizer]
    language._model((("de", "die Katze"),))
    assert len(base.KEPT) == 1
    base.KEPT.clear()
