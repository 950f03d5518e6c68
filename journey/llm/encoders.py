"""Library tokenizers inside tasks: texts are cut where no token can cross, and batches are balanced by bytes.

A cut is safe where the tokenizer file's own rules forbid a token across it, so
that the ids of a text are the ids of its pieces, one after the other:

* byte-level BPE with the usual splitting rule, and the lower-casing word BPE:
  before an ASCII white-space character that follows a character which is not
  white space; in long stretches without white space also between an ASCII
  letter and an ASCII digit and before CJK punctuation after a letter or digit.
* ``sentencepiece`` models without normalisation whose pieces never hold the
  space mark after another character: before a space that follows another
  character.  The space is then the prefix that the model puts before a piece.

The rules are read from the file when it is loaded.  A file of another make is
given each text whole.  Pieces that come again are encoded once per worker, as
long as the bounded memory has room.
"""

from __future__ import annotations

import json
import os
import re
import struct
from itertools import chain

# --- the operators' parameters --------------------------------------------------------------
#: bytes of text in one call of the library
BATCH_BYTES = 256 << 10
#: code points after which a long text is cut at the next safe place
LONG = 128 << 10
#: pieces a worker remembers, and the longest of them in code points
REMEMBER, REMEMBER_CHARS = 400_000, 48
# ---------------------------------------------------------------------------------------------

_WHITE = " \t-\r"
_PIECE = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
#: a further white-space character before an ASCII one: the two belong to one run
_ODD = re.compile(f"[^\\S{_WHITE}][{_WHITE}]")
_CUT = re.compile(f"(?<=\\S)(?=[{_WHITE}])")
_LONG_CUT = re.compile(f"(?<=\\S)(?=[{_WHITE}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
                       "|(?<=[^\\W_])(?=[、。！，：；？])")
_MARK = "▁"
_SPACE_PIECE = re.compile(" *[^ ]+(?: +\\Z)?| +\\Z")
_SPACE_CUT = re.compile(f"(?<=[^ {_MARK}])(?= [^ ])")
#: the splitting rules for which the cuts above are known to be safe
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _json_rule(made: dict) -> bool:
    """Whether the white-space cuts are safe for this ``tokenizers`` file."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s|[0-9]|[^\x00-\x7f]", t["content"])
           for t in made["added_tokens"]):
        return False
    normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [made["normalizer"]] if made["normalizer"] else [])]
    split = made["pre_tokenizer"] or {}
    split = split.get("pretokenizers", [split])
    if [s.get("type") for s in split] == ["ByteLevel"]:
        return not normal and split[0].get("use_regex", True) and not split[0]["add_prefix_space"]
    return ([s.get("type") for s in split] == ["Split", "ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]
            and split[0]["pattern"] == {"Regex": _WORD_RULE} and split[0]["invert"]
            and not split[1]["add_prefix_space"])


class Encoder:
    """One tokenizer file: ``.json`` by ``tokenizers``, ``.model`` by ``sentencepiece``; no added tokens, no cutting off.

    ``plain`` makes the strings of special tokens inside texts ordinary text
    where the library would take them for the tokens (``tokenizers`` only;
    ``sentencepiece`` always reads them as text).
    """

    loaded: dict[tuple[str, bool], Encoder] = {}

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.model = path.endswith(".model")
        if self.model:
            import sentencepiece
            from sentencepiece import sentencepiece_model_pb2 as made

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            proto = made.ModelProto()
            proto.ParseFromString(self.library.serialized_model_proto())
            rule = proto.normalizer_spec
            self.cuts = (rule.name == "identity" and not rule.precompiled_charsmap and rule.add_dummy_prefix
                         and not rule.remove_extra_whitespaces and rule.escape_whitespaces
                         and not any(p.type == p.USER_DEFINED for p in proto.pieces)
                         and not any(_MARK in p.piece.lstrip(_MARK) for p in proto.pieces))
        else:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.library.encode_special_tokens = plain
            self.cuts = _json_rule(json.loads(self.library.to_str()))
        self.known: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}

    @classmethod
    def of(cls, path: str, plain: bool = False) -> Encoder:
        if (path, plain) not in cls.loaded:
            cls.loaded[path, plain] = cls(path, plain)
        return cls.loaded[path, plain]

    def spans(self, text: str):
        """``text`` in stretches of about ``LONG`` code points, cut at safe places; a stretch without any stays whole.

        Stretches of a ``sentencepiece`` model come without the space that the model adds.
        """
        if not self.cuts or len(text) <= LONG or self.model and _MARK in text:
            yield text
            return
        cut, start = _SPACE_CUT if self.model else _LONG_CUT, 0
        while len(text) - start > LONG:
            m = cut.search(text, start + LONG)
            if m is None:
                break
            yield text[start:m.start()]
            start = m.start() + self.model
        yield text[start:]

    def pieces(self, span: str) -> list[str]:
        """The pieces of a stretch; their ids in a row are its ids."""
        if not span:
            return []
        if not self.cuts:
            return [span]
        if not self.model:
            return _PIECE.findall(span) if _ODD.search(span) is None else _CUT.split(span)
        if _MARK in span:
            return [span]
        found = _SPACE_PIECE.findall(span)
        return found[:1] + [p[1:] for p in found[1:]]

    def batches(self, pieces):
        """Lists of pieces of about ``BATCH_BYTES`` bytes each, one piece at least."""
        batch, size = [], 0
        for p in pieces:
            n = len(p) if p.isascii() else len(p.encode("utf-8", "replace"))
            if batch and size + n > BATCH_BYTES:
                yield batch
                batch, size = [], 0
            batch.append(p)
            size += n
        if batch:
            yield batch

    def encode(self, pieces):
        """(piece, ids) of each piece, by batch calls of the library."""
        for batch in self.batches(pieces):
            if self.model:
                yield from zip(batch, self.library.encode(batch, num_threads=1), strict=True)
            else:
                got = self.library.encode_batch(batch, add_special_tokens=False)
                yield from ((p, e.ids) for p, e in zip(batch, got, strict=True))

    def lengths(self, pieces):
        """(piece, number of ids) of each piece; the ids stay in the library."""
        for batch in self.batches(pieces):
            if self.model:
                yield from ((p, len(e)) for p, e in zip(batch, self.library.encode(batch, num_threads=1), strict=True))
            else:
                got = self.library.encode_batch(batch, add_special_tokens=False)
                yield from ((p, len(e)) for p, e in zip(batch, got, strict=True))

    def _cover(self, memory: dict, pieces: list[list[str]], new) -> list[str]:
        """Put what the pieces have into memory, by ``new(missing pieces)``; returns the long ones, to be taken out after use.

        A full memory is emptied first, so that it holds what the latest texts say.
        """
        wanted = set(chain.from_iterable(pieces))
        missing = wanted.difference(memory)
        if len(memory) + len(missing) > REMEMBER:
            memory.clear()
            missing = wanted
        if missing:
            memory.update(new(sorted(missing)))
        return [p for p in missing if len(p) > REMEMBER_CHARS]

    def count(self, texts: list[str]) -> list[int]:
        """Numbers of ids of the texts, a bounded number of code points at a time."""
        total = [0] * len(texts)
        for rows, spans in self._groups(texts):
            pieces = [self.pieces(s) for s in spans]
            long = self._cover(self.counts, pieces, self.lengths)
            for i, p in zip(rows, pieces, strict=True):
                total[i] += sum(map(self.counts.__getitem__, p))
            for p in long:
                del self.counts[p]
        return total

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts as little-endian unsigned 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for rows, spans in self._groups(texts):
            pieces = [self.pieces(s) for s in spans]
            long = self._cover(self.known, pieces, self._packed)
            for i, p in zip(rows, pieces, strict=True):
                out[i].extend(map(self.known.__getitem__, p))
            for p in long:
                del self.known[p]
        return [b"".join(x) for x in out]

    def _packed(self, pieces):
        return ((p, struct.pack(f"<{len(ids)}I", *ids)) for p, ids in self.encode(pieces))

    def _groups(self, texts: list[str]):
        """Rows and stretches of theirs, about ``LONG`` code points at a time."""
        rows, spans, size = [], [], 0
        for i, text in enumerate(texts):
            for s in self.spans(text):
                if rows and size + len(s) > LONG:
                    yield rows, spans
                    rows, spans, size = [], [], 0
                rows.append(i)
                spans.append(s)
                size += len(s)
        if rows:
            yield rows, spans

