"""Replacement tokens, word lists and match patterns.

Everything in this module is data.  The values decide which characters are
matched and what replaces them, so they are fixed; the engine that applies them
lives in :mod:`scrubwell.functions`.

Patterns are ``java.util.regex`` patterns.  ``(?U)`` gives ``\\w \\d \\s \\b``
their Unicode meaning, so accented letters count as word characters.
Possessive quantifiers (``++``) are used where giving back characters can never
lead to a match, which keeps long runs linear and off the JVM stack.
"""

# --- fixed values: replacement tokens -------------------------------------
TOKENS = {
    "EMAIL": "[EMAIL_REDACTED]",
    "PHONE": "<PHONE>",
    "SSN": "[SSN_REDACTED]",
    "CC": "[CREDIT_CARD_REDACTED]",
    "IPV4": "[IPV4_REDACTED]",
    "IPV6": "[IPV6_REDACTED]",
    "UUID": "[UUID_REDACTED]",
    "URL": "[URL_REDACTED]",
    "PATH": "[PATH_REDACTED]",
    "NAME": "[NAME_REDACTED]",
    "PROFANITY": "[PROFANITY_REDACTED]",
    "MAC": "[MAC_REDACTED]",
    "TIMESTAMP": "[TIMESTAMP_REDACTED]",
    "CURRENCY": "[CURRENCY_REDACTED]",
    "HTML": "[HTML_REDACTED]",
    "CODE": "[CODE_REDACTED]",
}

# Currency amounts met inside a phone candidate get their own short token.
CANDIDATE_CURRENCY_TOKEN = "<CURRENCY>"

# --- fixed values: word lists ---------------------------------------------
PROFANITY = ("damn", "shit", "fuck", "bitch", "asshole", "bastard", "crap", "prick")
CURRENCY_CODES = ("USD", "EUR", "GBP", "JPY", "CNY", "AUD", "CAD", "INR", "RUB", "KRW", "BRL")
CURRENCY_SYMBOLS = "$€£¥₩₹₽₴₪₫₱฿₦"

# --- fixed values: patterns -----------------------------------------------
# A look-ahead in front names what every match begins with.  It takes nothing and changes no match: it
# turns most places of a text down before a word boundary is asked for, which is costly in Unicode.
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX = "0123456789abcdefABCDEF"
EMAIL = rf"(?Ui)(?-iU:(?<![{_LETTERS}])(?=[^ @]*+@))" r"(?<![/\w.\-])[a-z0-9._%+\-]++@[a-z0-9.\-]+\.[a-z]{2,}"
URL = r"(?Ui)(?=[fhw])(?:(?:https?|ftp)://|www\.)[^\s<>\"]++"
IPV4 = r"(?U)(?=\d)\b(?:\d{1,3}\.){3}\d{1,3}\b"
IPV6 = rf"(?U)(?=[{_HEX}:])\b[0-9a-fA-F:]{{2,45}}\b"
# Those of them that hold a colon, as every address does.
IPV6_COLON = rf"(?U)(?=[{_HEX}]*+:)\b[0-9a-fA-F:]{{2,45}}\b"
UUID = (
    rf"(?U)(?=[{_HEX}]{{8}}-)"
    r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}"
    r"-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\b"
)
MAC = rf"(?U)(?=[{_HEX}][{_HEX}][:-])" r"\b(?:[0-9A-Fa-f]{2}[:-]){5}(?:[0-9A-Fa-f]{2})\b"
SSN = r"(?U)(?=\d)\b\d{3}-\d{2}-\d{4}\b"
CREDIT_CARD = r"(?U)(?=\d)\b(?:\d[ -]*?){13,16}\b"
PATH_WINDOWS = r"[A-Za-z]:\\(?:[^\\/:*?\"<>|\r\n]++\\)*+[^\\/:*?\"<>|\r\n]*+"
PATH_UNIX = r"(?U)(?=/)(?:/[\w\-.]++)++/?+"
TIMESTAMP_ISO = (
    r"(?U)(?=\d)\b\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"
    r"(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?\b"
)
TIME_SIMPLE = r"(?U)(?=\d)\b\d{1,2}:\d{2}(?::\d{2})?\b"
HTML_TAG = r"<[^>]+>"
CODE_FENCE = r"```[\s\S]*?```"
CODE_INLINE = r"`[^`]*`"
# One by one: the JVM looks a list up in one table and asks ranges in turn.
CONTROL = "[" + "".join(
    rf"\x{code:02X}" for code in (*range(9), 0x0B, 0x0C, *range(0x0E, 0x20), *range(0x7F, 0xA0))
) + "]"
# Unassigned code points stay: what the JVM does not know yet may be printable.
NONPRINTABLE = r"(?=[^ -~])[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Z}&&[^ ]]"
SPACE = r"(?U)[\s\x1C-\x1F]"
SPACES = SPACE + "+"
REPEATED_CHAR = r"(?d)(.)\1{4,}"
SENTENCE_BREAK = r"(?U)(?<=[.?!])[\s\x1C-\x1F]+"
PHONE_CANDIDATE = rf"(?U)(?=[^{_LETTERS}]{{7}})" r"(?<!\w)(\+?[\d\-.\s()]{6,}\d)(?!\w)"

DATE_ISO = r"(?U)^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}\s*\z"
DATE_DMY = r"(?U)^\s*\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\s*\z"
DATE_YEAR = r"(?U)^\s*\d{4}\s*\z"
DATE_BRACKETS = "()[]\"'"

_SYMBOL = f"[{CURRENCY_SYMBOLS}]"
_CODE = "(?:" + "|".join(CURRENCY_CODES) + ")"
_NUMBER = r"(?:\d{1,3}(?:[,.\s]\d{3})+|\d+(?:[.,]\d+)?)"
CURRENCY_SYMBOL = _SYMBOL
CURRENCY_CODE = rf"(?Ui)\b{_CODE}\b"
CURRENCY_AMOUNT = rf"(?U)^\s*{_SYMBOL}?\s*-?{_NUMBER}\s*{_SYMBOL}?(?:\s*{_CODE})?\s*\z"
CURRENCY_CODED = rf"(?Ui)\b\d[\d,.]*\s*{_CODE}\b"
# An amount inside running text: it must carry a symbol or a code, and it may
# not be cut out of a longer number.
_INLINE_NUMBER = r"(?:\d{1,3}(?:[,.\s]\d{3})+(?:[.,]\d{1,2})?|\d+(?:[.,]\d+)?)(?!\d)"
CURRENCY_INLINE = (
    rf"(?U){_SYMBOL}\s*-?{_INLINE_NUMBER}(?:\s*{_CODE}\b)?"
    rf"|(?<![\w.,])-?{_INLINE_NUMBER}(?:\s*{_SYMBOL}|\s*{_CODE}\b)"
)

# One colon-separated hex string is an address only if it has all eight groups
# or the "::" abbreviation.
IPV6_FULL = r"^(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\z"

# The 32 ASCII punctuation marks, as the inside of a character class.
ASCII_PUNCTUATION = r"!-/:-@\[-`{-~"
WORD_PIECES = rf"(?U)[^{ASCII_PUNCTUATION}\s]++|[{ASCII_PUNCTUATION}\s]"
# Runs of word characters, single other characters: cut at every word boundary.
WORDS_AND_MARKS = r"(?U)\w++|\W"
# A term that begins and ends with a word character.
WHOLE_WORDS = r"(?Us)^\w(?:.*\w)?\z"
# Whatever holds a digit, a slash, an at sign, an underscore or colon-separated hex:
# numbers, addresses of machines, paths, identifiers.
GUARDED_TOKEN = r"\S*(?:[0-9/\\@_]|[0-9A-Fa-f]:[0-9A-Fa-f:])\S*"
# A space, or a word between spaces with one mark behind it at most.  None of the alternatives for
# addresses and guarded tokens can match there, so asking this first settles most of a text cheaply.
PLAIN_PIECE = r"[ \n]|(?<![^ \n])[a-zA-Z\xC0-\u024F]++(?=[.,;!?]?[ \n])"
# The same cut with web and e-mail addresses and such tokens kept whole.
GUARDED_PIECES = (
    "(?U)" + PLAIN_PIECE + "|(?i:" + URL.removeprefix("(?Ui)") + ")|(?i:" + EMAIL.removeprefix("(?Ui)") + ")|"
    + GUARDED_TOKEN + "|"
    + WORD_PIECES.removeprefix("(?U)")
)
# A word made of letters only, and one that does not start with a capital.
LETTERS_ONLY = r"^\p{L}[\p{L}\p{M}]*+\z"
LOWER_WORD = r"^(?![\p{Lu}\p{Lt}])\p{L}[\p{L}\p{M}]*+\z"

# Mis-decoded UTF-8 read as windows-1252: a lead byte followed by continuation
# bytes, where 0x80-0x9F may show up as windows-1252 punctuation.
CP1252_MARKS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)
MOJIBAKE_SPAN = rf"[Â-ô][\u0080-¿{CP1252_MARKS}]+"

# Characters that can make a text differ from its NFC form: marks, conjoining
# Hangul, characters with a canonical decomposition that is not undone, and
# code points the JVM does not know yet.  Texts without any are NFC already.
# The range in front lets ordinary Latin text pass without a category lookup.
NFC_SUSPECT = (
    r"[\u0300-\x{10FFFF}&&"
    r"[\p{M}\p{Cn}\u0374\u037E\u0387\u0958-\u095F\u09DC-\u09DF\u0A33-\u0A5E"
    r"\u0B5C\u0B5D\u0F43-\u0F69\u1100-\u11FF\u1F70-\u1FFF\u2000\u2001"
    r"\u2126-\u212B\u2329\u232A\u2ADC\uF900-\uFAFF\uFB1D-\uFB4F"
    r"\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1F}]]"
)
