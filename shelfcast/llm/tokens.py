"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa

#: The id that ends every document.
END = 0
#: Texts longer than this are encoded in runs, cut where the word rule always cuts.
RUN_CHARS = 1 << 20
#: Texts of these characters only (Latin letters, usual signs and white space) may take the
#: faster library; for them both libraries' word rules read every character alike.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]")
_SAFE_CUT = re.compile(r"(?<=\S) (?=[A-Za-z])")
PATTERN = public_tokenizers.PATTERN
#: The words of ``PATTERN``, found with less backtracking: a run of one kind is never given back, and
#: white space at the end of the text is taken at once.
FAST_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def default_paths() -> tuple[str, str]:
    """The tokenizer file, and the same vocabulary as ranks."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def runs(text: str, size: int = RUN_CHARS) -> list[str]:
    """Cut a long text before single spaces between a non-space and a letter.

    The word rule starts a new word at each such space, whatever stands around it,
    so the ids of the runs, joined, are the ids of the text.
    """
    out, at = [], 0
    while len(text) - at > size:
        m = _SAFE_CUT.search(text, at + size)
        if m is None:
            break
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


class Encoder:
    """Ids as ``Tokenizer.from_file(paths[0]).encode(text, add_special_tokens=False)`` gives them.

    Plain texts are encoded from the ranks in ``paths[1]`` (if given), which takes a
    third of the time; all others, and those with a special token's string, by the
    tokenizer itself.
    """

    def __init__(self, paths: tuple[str, str | None], pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(paths[0])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if paths[1]:
            import tiktoken

            with open(paths[1], "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            rule = FAST_PATTERN if pattern == PATTERN else pattern
            self.fast = tiktoken.Encoding("ranks", pat_str=rule, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def shared(cls, paths: tuple[str, str | None], pattern: str) -> Encoder:
        """The process's encoder of these files: a worker loads a vocabulary once, not for every task."""
        # functions travel by value, so what outlives a task is kept in a module of its own
        kept = sys.modules.setdefault("_shelfcast_encoders", ModuleType("_shelfcast_encoders")).__dict__
        key = repr((paths, pattern))
        if key not in kept:
            kept[key] = cls(paths, pattern)
        return kept[key]

    def ids(self, text: str) -> np.ndarray:
        """uint32 ids of the whole text, END included."""
        parts = []
        for run in runs(text):
            if self.fast is not None and not _OTHER.search(run) and not any(s in run for s in self.special):
                found = self.fast.encode_ordinary(run)
            else:
                found = self.tokenizer.encode(run, add_special_tokens=False).ids
            parts.append(np.frombuffer(array("I", found), "<u4"))  # half the time of np.array
        return np.concatenate([*parts, np.array([END], "<u4")])

    def all_ids(self, texts: pa.Array, rows: int = 500) -> Iterator[np.ndarray]:
        """The ids of each text (null: empty); ``rows`` texts at a time leave the batch."""
        for a in range(0, len(texts), rows):
            for t in texts.slice(a, rows).to_pylist():
                yield self.ids(t or "")
