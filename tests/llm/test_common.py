"""What Python workers remember: one thing at a time, within its bytes."""

from tillmart.llm.common import Remembered, kept


class Doubled(Remembered):
    most_bytes = 20_000

    def find(self, key):
        return key * 2


def test_another_name_lets_the_former_go():
    first = kept("a", Doubled)
    first[b"x"]
    assert kept("a", Doubled) is first
    second = kept("b", dict)
    assert second == {}
    again = kept("a", Doubled)
    assert again is not first and len(again) == 0
    kept("", dict)


def test_remembered_stays_within_its_bytes():
    words = Doubled()
    for n in range(5000):
        key = b"%d" % n
        assert words[key] == key * 2
        assert (len(words) + len(words.older)) * Doubled.entry_bytes <= Doubled.most_bytes
    assert len(words) > 0 and b"4999" in words


def test_long_keys_are_not_kept():
    words = Doubled()
    assert words[b"y" * 65] == b"y" * 130 and not words
