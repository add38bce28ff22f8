"""Ids of a word-level BPE vocabulary (a tokenizers JSON file), fast for Latin texts.

encode(texts) gives for each text what tokenizers' encode(text, add_special_tokens=False) gives.
Texts of ASCII and Latin-1 characters without special tokens take a quick way: numpy lower-cases
them and marks the end of each pre-token, and a rank-ordered BPE merges all of a batch in one
call, with the end mark as one more byte. Every other text goes through tokenizers itself. A
vocabulary of another shape than word ends, byte-level letters and merges in id order goes there always.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: The file's pre-tokenizer and normalizer steps that the quick way stands in for.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
CONTRACTIONS = ["s", "t", "m", "d", "re", "ve", "ll"]

LETTER, DIGIT, SPACE, OTHER, BAD, SHORT = range(6)
END, DOC = b"\x00", b"\x01"
AT_ONCE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes() -> np.ndarray:
    out = np.full(256, BAD, np.uint8)
    for b in range(9, 256):
        kind = unicodedata.category(chr(b))[0]
        if chr(b) in " \t\n\r":
            out[b] = SPACE
        elif kind == "L":
            out[b] = LETTER
        elif kind == "N":
            out[b] = DIGIT
        elif kind != "C" and not chr(b).isspace():
            out[b] = OTHER
    return out


class WordBpe:
    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = self.slow.get_vocab_size()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.quick = self._quick(spec)
        if self.quick:
            self.classes = _classes()
            self.lower = np.array([ord(chr(b).lower()) if len(chr(b).lower()) == 1 and ord(chr(b).lower()) < 256 else b for b in range(256)], np.uint8)

    def _quick(self, spec: dict) -> tiktoken.Encoding | None:
        model, vocab = spec["model"], spec["model"]["vocab"]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges", [])]
        ids = [vocab[p] for p in pairs if p in vocab]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or steps != STEPS or not splits or splits[0]["pattern"] != {"Regex": SPLIT} or ids != sorted(set(ids)) or len(ids) != len(pairs):
            return None
        special, letters = {t["content"] for t in spec["added_tokens"]}, byte_letters()
        ranks = {}
        for token, i in vocab.items():
            if token not in special:
                body, end = (token[:-4], END) if token.endswith("</w>") else (token, b"")
                ranks[bytes(letters[c] for c in body) + end] = i
        self.doc_id = ranks[DOC + END]
        return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One uint32 array for each text; AT_ONCE characters at a time, or one longer text."""
        out: list = [None] * len(texts)
        raw, easy, n = [], [], 0

        def merge() -> None:
            nonlocal n
            for i, ids in zip(easy, self._batch(raw) if raw else []):
                out[i] = ids
            raw.clear(), easy.clear()
            n = 0

        for i, t in enumerate(texts):
            b = self._latin(t)
            if b is None:
                out[i] = np.array(self.slow.encode(t, add_special_tokens=False).ids, np.uint32)
                continue
            if n + len(b) > AT_ONCE:
                merge()
            raw.append(b), easy.append(i)
            n += len(b)
        merge()
        return out

    def _latin(self, text: str) -> bytes | None:
        if not self.quick:
            return None
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if (self.classes[np.frombuffer(raw, np.uint8)] == BAD).any() or any(s in text for s in self.special):
            return None
        return raw

    def _batch(self, raw: list[bytes]) -> list[np.ndarray]:
        buf = self.lower[np.frombuffer((b"\n" + DOC + b"\n").join(raw) + b"\n" + DOC + b"\n", np.uint8)]
        kind = self.classes[buf]
        kind[buf == DOC[0]] = OTHER
        first = np.empty(len(buf), bool)
        for p in np.flatnonzero(buf == ord("'")):
            if p and kind[p - 1] == OTHER:
                continue
            tail = buf[p + 1 : p + 3].tobytes().decode("latin-1")
            n = next((len(c) for c in CONTRACTIONS if tail.startswith(c)), 0)
            if n:
                kind[p] = SHORT
                kind[p + 1 : p + 1 + n] = SHORT
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        first |= kind == DIGIT
        first |= (kind == SHORT) & (buf == ord("'"))
        solid = kind != SPACE
        last = np.append(first[1:], True)[solid]
        body = buf[solid]
        marked = np.zeros(len(body) + int(last.sum()), np.uint8)
        marked[np.arange(len(body)) + np.cumsum(last) - last] = body
        ids = self.quick.encode_to_numpy(marked.tobytes().decode("latin-1"), disallowed_special=())
        ends = np.flatnonzero(ids == self.doc_id)
        starts = np.append(0, ends[:-1] + 1)
        return [ids[a:b] for a, b in zip(starts, ends)]


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The vocabulary at path, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
