import random

import numpy as np

from wxmesh.llm import features


def codes(raw):
    return features.word_codes(raw, *features.spans(~features.SPACE[np.frombuffer(raw, np.uint8)])).tolist()


def test_a_word_has_one_code_wherever_it_stands_and_all_of_it_counts():
    rng = random.Random(1)
    words = ["https://example.com/aaaaaa1", "https://example.com/aaaaaa2", "x" * 5000, "x" * 4999 + "y", "北京是中华人民共和国", "北京是中华人民共和園", "a", "aa"]
    words += ["".join(rng.choices("ab", k=rng.randrange(1, 40))) for _ in range(300)]
    text = [rng.choice(words) for _ in range(4000)]
    by = dict(zip(text, codes(" ".join(text).encode())))
    assert [by[w] for w in text] == codes(("\n\n" + "\t ".join(text)).encode())
    assert len(set(by.values())) == len(by)
    long = b"z" * (features.POWERS_KEPT + 10) + b" " + "  ".join(text).encode()
    assert codes(long)[1:] == [by[w] for w in text]
    assert codes(b"") == [] and codes(b"  ") == []
