"""Text and hash expressions."""

from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)"
IP_PATTERN = rf"(?<!\d)(?!0){_OCTET}(?:\.{_OCTET}){{3}}(?!\d)"



def _c(column):
    return F.col(column) if isinstance(column, str) else column


def md5_hex(text):
    return F.md5(_c(text))


def digest_hex(text, algorithm="MD5", upper=True):
    """Hex digest by algorithm name: MD5, SHA-1, SHA-224, SHA-256, SHA-384 or SHA-512."""
    name = algorithm.upper().replace("-", "")
    hexed = F.md5(_c(text)) if name == "MD5" else F.sha1(_c(text)) if name == "SHA1" else F.sha2(_c(text), int(name[3:]))
    return F.upper(hexed) if upper else hexed


def zero_pad(number, width):
    """An integer with leading zeros up to `width` characters, sign included; never cut."""
    n = _c(number)
    digits, sign = F.abs(n).cast("string"), F.when(n < 0, "-").otherwise("")
    space = F.lit(width) - F.length(sign)
    return F.concat(sign, F.lpad(digits, F.greatest(space, F.length(digits)), F.lit("0")))


def fill_right(text, width, fill):
    """Text with `fill` appended once per missing character; longer or empty text stays."""
    missing = F.lit(width) - F.length(_c(text))
    return F.when((missing > 0) & (_c(text) != ""), F.concat(_c(text), F.repeat(F.lit(fill), missing))).otherwise(_c(text))


def without_spaces(text):
    """Text with all white space removed, '' for null."""
    return F.coalesce(F.regexp_replace(_c(text), r"\s+", ""), F.lit(""))


def is_number(text):
    """Digits only, at least one."""
    return F.coalesce(_c(text).rlike(r"^\d+\z"), F.lit(False))


def is_one_of(text, values):
    return F.coalesce((_c(text) != "") & _c(text).isin(*values), F.lit(False))


def has_part(text, part, ignore_case=False):
    """Whether a non-empty `part` occurs in the text."""
    a, b = _c(text), F.lit(part)
    if ignore_case:
        a, b = F.lower(a), F.lower(b)
    return F.coalesce(a.contains(b) & F.lit(part != ""), F.lit(False))


def split_text(text, pattern):
    """Parts between matches of a regular expression, empty parts at the end dropped; null for ''."""
    body = F.regexp_replace(_c(text), f"(?:{pattern})+\\z", "")
    return F.when(_c(text) != "", F.split(body, pattern))


def join_text(array, sep):
    """Array elements joined; null for an empty array or separator."""
    return F.when((F.size(_c(array)) > 0) & F.lit(sep != ""), F.array_join(_c(array), sep))


def url_encoded(text):
    return F.when(_c(text) != "", F.url_encode(_c(text)))


def recharset(text, written_as, read_as):
    """The text's bytes in one character set read in another."""
    return F.when(_c(text) != "", F.decode(F.encode(_c(text), written_as), read_as))


def underscored(key):
    """Key with dots turned into underscores."""
    return F.replace(_c(key), F.lit("."), F.lit("_"))


def ip_addresses(text):
    """All IPv4 addresses in the text."""
    return F.regexp_extract_all(_c(text), F.lit(IP_PATTERN), F.lit(0))
