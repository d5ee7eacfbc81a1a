r"""Patterns of the text rules.

``\z`` stands where the pattern must reach the very end: ``$`` would also match
in front of a final line feed.  The e-mail and URL patterns use character
classes and look-aheads instead of repeated groups: Java matches a repeated
group recursively, so one hostile text of some thousand labels would end the
task with a stack overflow, and nested repeats would take exponential time.
"""

# The characters of an e-mail's local part and of its labels.
_LOCAL = r"[a-zA-Z0-9.!#$%&'*+\/=?^_`{|}~-]+"
_LABEL_END = "[a-zA-Z0-9]"
_LONGEST_LABEL = 63
# Labels start and end with a letter or digit and hold at most 63 characters.
EMAIL = (
    rf"^{_LOCAL}@(?={_LABEL_END})(?!.*(?:\.\.|\.-|-\.))(?!.*[^.]{{{_LONGEST_LABEL + 1}}})"
    rf"[a-zA-Z0-9.-]*(?<={_LABEL_END})\z"
)

# Versions 1 to 5, or all zeros.
UUID = (
    r"(?i)^(?:[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"
    r"|00000000-0000-0000-0000-000000000000)\z"
)

# A full date and time with zone.
DATETIME = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(([+-]\d{2}(:?\d{2})?)|Z)\z"
)

# Characters beyond ASCII that may stand in a URL, private-use
# characters that may stand in its query, and its delimiters.
_WIDE = r"\u00A0-\uD7FF\uF900-\uFDCF\uFDF0-\uFFEF"
_PRIVATE = r"\uE000-\uF8FF"
_DELIMITERS = r"!$&'()*+,;="

_LETTER = f"[a-z{_WIDE}]"
_ALNUM = rf"[a-z\d{_WIDE}]"
_PLAIN = rf"a-z\d._~{_WIDE}\-"
# Every per cent sign must start an escape; the look-ahead checks all of them
# at once, so that the sign can be an ordinary character below.
_ESCAPES = r"(?!.*%(?![\da-f]{2}))"
_USER = f"[{_PLAIN}%{_DELIMITERS}:]*@"
_PATH = f"{_PLAIN}%{_DELIMITERS}:@"
_OCTET = r"(?:\d|[1-9]\d|1\d\d|2[0-4]\d|25[0-5])"
_ADDRESS = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_DOMAIN = rf"{_ALNUM}(?:[{_PLAIN}]*{_ALNUM})?\.{_LETTER}(?:[{_PLAIN}]*{_LETTER})?\.?"
URL = (
    rf"(?i)^{_ESCAPES}(?:(?:https?|ftp):)?//(?:{_USER})?(?:{_ADDRESS}|{_DOMAIN})(?::\d*)?"
    rf"(?:/(?!/)[{_PATH}/]*)?(?:\?[{_PATH}{_PRIVATE}/?]*)?(?:#[{_PATH}/?]*)?\z"
)
