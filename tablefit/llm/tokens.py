"""Byte-level BPE vocabularies: loading, whole-text ids, pieces of pre-tokens.

The vocabulary file (``.json`` of the tokenizers library) is read on the driver
and travels as a broadcast of its few MB; workers build their encoder once.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

_BUILT: dict = {}
#: White space as Unicode has it, and the length from which a run of it is taken by itself.
WORD_SPACE = "\\x09-\\x0d\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_RUN = 100_000


def vocabulary(spark: SparkSession, path: str):
    """A broadcast of the vocabulary file (its size is that of the file)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def id_encoder(spec: str):
    """A function text -> uint32 ids, special strings of the file recognised as
    the tokenizers library does by default; no special tokens are added. Runs of
    ``LONG_RUN`` white spaces or more, on which the matcher of ``tiktoken`` gives
    up, go through the library by themselves."""
    key = ("ids", hash(spec))
    if key not in _BUILT:
        import os
        import re

        import numpy as np
        import public_tokenizers
        import tiktoken

        j = json.loads(spec)
        special = {t["content"]: t["id"] for t in j["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in j["model"]["vocab"].items() if t not in special}
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        allowed = set(special)
        blanks = re.compile(f"[{WORD_SPACE}]{{2,}}")
        library = []

        def fast(text):
            return enc.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

        def run_ids(text):
            if not library:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                from tokenizers import Tokenizer

                library.append(Tokenizer.from_str(spec))
            return np.array(library[0].encode(text, add_special_tokens=False).ids, np.uint32)

        def ids(text):
            if len(text) < LONG_RUN:
                return fast(text)
            out, at = [], 0
            for m in blanks.finditer(text):
                a, b = m.span()
                if b - a >= LONG_RUN:
                    # A run is one pre-token but for its last character, which starts what follows.
                    end = b if b == len(text) else b - 1
                    out += [fast(text[at:a]), run_ids(text[a:end])]
                    at = end
            return np.concatenate([*out, fast(text[at:])]) if out else fast(text)

        _BUILT[key] = ids
    return _BUILT[key]


def piece_counter(spec: str):
    """``(split, count)``: a text's pre-tokens and number of special strings;
    the numbers of pieces of a list of pre-tokens."""
    key = ("pieces", hash(spec))
    if key not in _BUILT:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        special = [t["content"] for t in json.loads(spec)["added_tokens"]]
        at = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        words = regex.compile(public_tokenizers.PATTERN).findall
        tok = Tokenizer.from_str(spec)

        def split(text):
            if at is None or not at.search(text):
                return words(text), 0
            parts = at.split(text)
            return [w for p in parts for w in words(p)], len(parts) - 1

        def count(pre_tokens):
            return [len(e.ids) for e in tok.encode_batch_fast(pre_tokens, add_special_tokens=False)]

        _BUILT[key] = (split, count)
    return _BUILT[key]


#: The layout of a word vocabulary that need not go through the library text by text.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                                       {"type": "Lowercase"}]}
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Characters of a text that are looked at together.
STRETCH = 1 << 20


#: Emoji that every version of Unicode since 6 has.
EMOJI = range(0x1F300, 0x1F650)


def _class(chosen, top: int) -> str:
    """The code points below ``top`` that are ``chosen``, as a regular expression's class."""
    import re
    from itertools import groupby

    runs = [list(g) for is_in, g in groupby(range(top), key=chosen) if is_in]
    return "".join(f"{re.escape(chr(r[0]))}-{re.escape(chr(r[-1]))}" for r in runs)


def word_encoder(spec: str):
    """A function text -> uint32 ids for a lower-casing word vocabulary, as
    ``tokenizers`` gives them: special strings recognised, none added.

    Pre-tokens are found here and handed to ``tiktoken`` with one blank after
    each: a blank never stands inside a pre-token, so it can play the
    vocabulary's end-of-word mark (its merges come first, as they do there).
    Pre-tokens hold no white space, so very long texts are cut there. A file of
    another layout, and a text with characters that were not in Unicode 3.2 (nor
    are emoji), where versions of Unicode may differ, go through the library."""
    key = ("words", hash(spec))
    if key not in _BUILT:
        import os
        import re
        import unicodedata

        import numpy as np
        import tiktoken

        j = json.loads(spec)
        model, steps = j["model"], (j.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        special = {t["content"]: t["id"] for t in j["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in t.removesuffix("</w>")) + b" " * t.endswith("</w>"): i
                 for t, i in model["vocab"].items() if t not in special}
        known = (j.get("normalizer") == WORD_NORMALIZER and steps[0].get("type") == "Split" and steps[0].get("invert")
                 and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and model.get("end_of_word_suffix") == "</w>"
                 and sorted(ranks.values()) == list(range(len(model["vocab"]) - sum(t in special for t in model["vocab"]))))
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(spec)

        def library(text):
            return np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)

        if not known:
            _BUILT[key] = library
            return library

        old = unicodedata.ucd_3_2_0.category

        def settled(c):
            return old(chr(c)) not in ("Cn", "Cs") or c in EMOJI

        def finder(top):
            letters, numbers = (_class(lambda c: unicodedata.category(chr(c))[0] == kind, top) for kind in "LN")
            return (re.compile(f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^{WORD_SPACE}{letters}{numbers}]+").findall,
                    re.compile(f"[^{_class(settled, top)}]").search)

        # Classes that end below U+10000 are tables, those that do not are searched: told apart by the text.
        (words, beyond), (all_words, unsettled) = finder(0x10000), finder(0x110000)
        space = re.compile(f"[{WORD_SPACE}]")
        at = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        encode = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

        def stretches(text):
            start = 0
            while len(text) - start > STRETCH:
                cut = space.search(text, start + STRETCH)
                if cut is None:
                    break
                yield text[start:cut.start()]
                start = cut.start()
            yield text[start:]

        def plain(text):
            if text.isascii():
                found = words(text.lower())
            else:
                find = words
                if beyond(text):
                    if unsettled(text):
                        return library(text)
                    find = all_words
                # Lower case character by character: only the final sigma depends on what surrounds it.
                found = find(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())
            return encode(" ".join(found) + " ") if found else np.zeros(0, np.uint32)

        def one(text):
            pieces = at.split(text) if at else [text]
            out = [np.array([special[p]], np.uint32) if p in special else plain(s) for p in pieces for s in ([p] if p in special else stretches(p))]
            return out[0] if len(out) == 1 else np.concatenate(out)

        _BUILT[key] = one
    return _BUILT[key]
