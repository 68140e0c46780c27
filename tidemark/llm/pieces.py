"""Texts cut where no merge of the tokenizer can cross, and caches of what the pieces give.

Both tokenizers start a new pre-token at a space that follows a character that
is neither a space nor a space's stand-in, so a text's tokens are those of the
segments between such spaces, one after the other.  Segments repeat often; the
library encodes only those a worker hasn't met.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import islice

#: A space after anything but white space or the space mark of piece vocabularies (U+2581).
_CUT = re.compile("(?<=[^\\s▁]) ")
#: What may stand before a space that is no cut: every white space character, and the mark.
_BEFORE = tuple(chr(c) + " " for c in (*range(0x3001), 0x2581) if chr(c).isspace() or c == 0x2581)
_BEFORE_ASCII = tuple(pair for pair in _BEFORE if pair.isascii())


def cut_at_every_space(text: str) -> bool:
    """Whether all spaces of a text are such spaces."""
    pairs = _BEFORE_ASCII if text.isascii() else _BEFORE
    return text[:1] != " " and not any(map(text.__contains__, pairs))


def segments(text: str) -> list[str]:
    """Cut at each such space; the space itself is dropped and stands before every segment but the first."""
    return text.split(" ") if cut_at_every_space(text) else _CUT.split(text)


class Tier(dict):
    """Segment to what it gives: a fixed frequent tier, and a bounded cache of the rest.

    ``encode`` is called with all missing segments of a group of texts at once.  A full
    cache keeps its older half, where the common segments are.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable], frequent: dict | None = None, limit: int = 400_000):
        super().__init__(frequent or {})
        self.encode, self.kept, self.limit = encode, len(self) + limit // 2, len(self) + limit

    def make_room(self, n: int) -> None:
        """Forget the newer half of a cache that ``n`` more entries would overfill."""
        if len(self) + n > self.limit and len(self) > self.kept:
            for segment in list(islice(self, self.kept, None)):
                del self[segment]

    def learn(self, wanted: set[str]) -> None:
        """Have an entry for every wanted segment."""
        missing = wanted.difference(self)
        if not missing:
            return
        self.make_room(len(missing))
        missing = list(wanted.difference(self))
        self.update(zip(missing, self.encode(missing)))
