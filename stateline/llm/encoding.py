"""Token ids of whole texts by a public byte-level BPE file, inside tasks.

The ids are those of the ``tokenizers`` library for the file, with special strings found in texts
as it finds them by default and no tokens added. Where the file's vocabulary is also at hand as
ranks, texts of plain Latin characters are encoded by ``tiktoken``, which gives the same ids about
four times as fast; texts with any other character, or with a special string, go to ``tokenizers``.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 18

# Characters whose class (letter, digit, space, other) the two libraries cannot see differently.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*")
# A single space between two other characters always starts a new word of the pattern.
_SAFE = re.compile(r"(?<=[^\s])[ ](?=[^\s])")


@functools.cache
def tokenizer(name: str = TOKENIZER):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@functools.cache
def _ranked(name: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _special(name: str) -> re.Pattern:
    found = [re.escape(t.content) for t in tokenizer(name).get_added_tokens_decoder().values()]
    return re.compile("|".join(found) or "(?!)")


def parts(text: str, most: int = PART_BYTES) -> list[str]:
    """The text cut at safe boundaries into runs of about ``most`` characters.

    The tokens of the runs are the tokens of the text: a cut lies before a single space between two
    characters that are not white space, where a new word begins whatever surrounds it. A text
    without such a place stays whole.
    """
    found, begin = [], 0
    while len(text) - begin > most:
        cut = _SAFE.search(text, begin + most)
        if cut is None:
            break
        found.append(text[begin : cut.start()])
        begin = cut.start()
    found.append(text[begin:])
    return found


def _together(pieces: list[str], plain: list[bool], name: str, ranks: str | None) -> list[np.ndarray]:
    """The ids of a batch of pieces: one call of each library, for those it takes."""
    found: list[np.ndarray] = [np.empty(0, np.uint32)] * len(pieces)

    def encode(mine: bool, batch_ids: Callable[[list[str]], Iterable[list[int]]]) -> None:
        at = [i for i, is_plain in enumerate(plain) if is_plain == mine]
        if at:
            for i, ids in zip(at, batch_ids([pieces[i] for i in at]), strict=True):
                found[i] = np.array(ids, np.uint32)

    encode(True, lambda texts: _ranked(ranks).encode_ordinary_batch(texts, num_threads=1))
    encode(False, lambda texts: (e.ids for e in tokenizer(name).encode_batch_fast(texts, add_special_tokens=False)))
    return found


def ids_of(texts: list[str], name: str = TOKENIZER, ranks: str | None = RANKS) -> Iterator[np.ndarray]:
    """For each text its token ids. Texts are encoded together, in batches of about ``BATCH_BYTES``
    characters; long ones are cut into parts at safe boundaries, which batches take like other texts."""
    special = _special(name)

    def batches() -> Iterator[list[tuple[int, str, bool]]]:
        batch, size = [], 0
        for i, text in enumerate(texts):
            plain = bool(ranks and _PLAIN.fullmatch(text) and not special.search(text))
            for piece in parts(text) if len(text) > PART_BYTES else [text]:
                batch.append((i, piece, plain))
                size += len(piece)
                if size >= BATCH_BYTES:
                    yield batch
                    batch, size = [], 0
        if batch:
            yield batch

    current, held = 0, []
    for batch in batches():
        owners, pieces, plain = map(list, zip(*batch, strict=True))
        for owner, ids in zip(owners, _together(pieces, plain, name, ranks), strict=True):
            if owner != current:
                yield held[0] if len(held) == 1 else np.concatenate(held)
                current, held = owner, []
            held.append(ids)
    if held:
        yield held[0] if len(held) == 1 else np.concatenate(held)
