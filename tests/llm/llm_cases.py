"""Texts that have gone wrong elsewhere, and the library's ids of whole texts."""

from tokenizers import Tokenizer

# Empty, blank, odd spaces, repeated, one very long.
ODD = [
    None, "", " ", "  \n\t ", "a", "a  b", " a ", "x\n\n y", "tab\tand no-break  　wide", "<|endoftext|> stays text",
    "don't we'll I'D", "\U0001F600 \U0001F600", "é", "same same", "same same", "long " * 30_000, "a" * 5000, "1234567 89",
    "\x1c \x1d\x85 z", "﻿mark",
]


def whole_ids(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [item.ids for item in tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)]
