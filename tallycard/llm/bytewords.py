"""Letters that byte-level tokenizers show bytes as, and words that need no more than them."""

import re

# Bytes that are a printable character of Latin-1 are shown as it, the others as the letters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [byte for byte in range(256) if byte not in _SHOWN]
LETTERS = {byte: chr(byte) for byte in _SHOWN} | {byte: chr(256 + at) for at, byte in enumerate(_HIDDEN)}
# For `str.translate`: the letters of Latin-1 beyond ASCII, as their two bytes are shown.
TWO_BYTES = {code: "".join(LETTERS[byte] for byte in chr(code).encode()) for code in range(192, 256)}
SPACE = LETTERS[32]

# Words of Latin-1 letters with a full stop or comma at most, which every splitting by kind of character cuts alike.
LOWER_WORD = re.compile("([a-zß-öø-ÿ]+)([.,]?)").fullmatch
SPACED_WORD = re.compile(" ([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)").fullmatch


def shown(word):
    """A word of Latin-1 letters in byte letters."""
    return word if word.isascii() else word.translate(TWO_BYTES)
