"""Byte-level BPE of a public vocabulary file, loaded once per worker."""

from __future__ import annotations

import functools
import json
import re

import numpy as np

#: Beyond these characters the tokenizers library itself splits the text.
PLAIN = re.compile(r"[\x00-ɏ‐-‧]*\Z")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def byte_chars() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in keep}
    spare = iter(range(256, 512))
    out.update({chr(next(spare)): b for b in range(256) if b not in set(keep)})
    return out


class ByteBPE:
    """Ids as the tokenizers library gives them for a byte-level BPE file.

    Merging in order of ids is the same as merging in order of the file's merge
    list when the list makes ids in ascending order; that is checked, and else
    the library encodes every text.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        self.path = path
        spec = json.load(open(path, encoding="utf-8"))
        vocab, back = spec["model"]["vocab"], byte_chars()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        special_ids = {t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in tok): i for tok, i in vocab.items() if i not in special_ids}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        ascending = all(a < b for a, b in zip(merged, merged[1:]))
        self.fast = None
        if ascending:
            self.fast = tiktoken.Encoding(
                "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        self.size = max([*vocab.values(), *special_ids]) + 1
        self.bytes_of = [b""] * self.size
        for tok, i in ranks.items():
            self.bytes_of[i] = tok
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()

    @functools.cached_property
    def lib(self):
        """The tokenizers library's own encoder, loaded for the first text that needs it."""
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(self.path)
        lib.no_truncation()
        lib.no_padding()
        return lib

    def ids(self, text: str, specials: bool = True) -> np.ndarray:
        """Ids of ``text``; with ``specials``, special strings in it become their ids."""
        held = any(s in text for s in self.specials)
        if self.fast is not None and not (held and specials) and PLAIN.match(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        self.lib.encode_special_tokens = not specials
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.uint32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.cache
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)
