"""Character classes, patterns and word lists.

Java's ``\\w \\s \\d`` are ASCII, and ``(?U)`` still misses the control separators and adds
combining marks, so every class is spelt out.
"""

# The character classes that give Python ``re``/``str`` results in Java.
SPACE_CHARS = r"\s\x0B\x1c-\x1f\x85\p{Z}"
SPACE = rf"[{SPACE_CHARS}]"
NON_SPACE = rf"[^{SPACE_CHARS}]"
WORD_CHARS = r"\p{L}\p{N}_"
WORD = rf"[{WORD_CHARS}]"
DECIMAL = r"\p{Nd}"
UPPER = r"\p{IsUppercase}"
ALPHA = r"\p{L}"
# Every code point whose Unicode numeric type is decimal or digit.
DIGIT_CHARS = (
    r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}"
    r"\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
# The look-ahead rejects letters by one category test before the long class is searched.
DIGIT = rf"(?:(?=\p{{N}})[{DIGIT_CHARS}])"

# Only the runs that are not already one plain space, so clean text is left untouched. The
# leading test passes over printable ASCII and the letters below U+1680, which has no space.
UNCLEAN_SPACE_RUN = (
    rf"(?![!-~\x{{A1}}-\x{{167F}}])(?: (?=[\x00{SPACE_CHARS}])|[^ ](?<=[\x00{SPACE_CHARS}]))[\x00{SPACE_CHARS}]*"
)
# A run of spaces is tried once, from its start.
EDGE_SPACE = rf"^{SPACE}+|(?<!{SPACE}){SPACE}++$"

# The published patterns, in explicit classes.
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
EMAIL = rf"[{WORD_CHARS}.\-]++@[{WORD_CHARS}.\-]+\.{WORD}+"
# The same matches in linear time: one can only start where a run does, or where the last one ended.
EMAIL_AT_RUN = rf"(?:\G|(?<![{WORD_CHARS}.\-])){EMAIL}"
HTML_TAG = r"<[^>]+>"
PHONE = (
    rf"(?:\+?{DECIMAL}{{1,3}}[-.{SPACE_CHARS}]?)?"
    rf"(?:\(?{DECIMAL}{{2,4}}\)?[-.{SPACE_CHARS}]?)?"
    rf"{DECIMAL}{{3,4}}[-.{SPACE_CHARS}]?{DECIMAL}{{4}}"
)
REPEATED_CHAR = r"([^\n])\1{3,}"
REPLY_PREFIX = rf"^(?:re|fw|fwd){SPACE}*:{SPACE}*"
PUNCTUATION = r"[!?.,;:\-_()\[\]{}]"
SENTENCE_END = r"[.!?]+"
LATIN_TOKEN = r"[A-Za-z']+"
VECTOR_TOKEN = rf"{WORD}{{2,}}"

# The published word lists.
SPAM_WORDS = (
    "spam", "free", "winner", "win", "urgent", "immediately", "offer", "discount",
    "bonus", "click", "buy", "cheap", "trial", "limited", "credit", "money",
)
PROMO_WORDS = (
    "free", "winner", "winning", "win", "urgent", "now", "immediately", "offer", "discount",
    "sale", "save", "deal", "cheap", "credit", "bonus", "gift", "prize",
)
UNSUBSCRIBE_PHRASES = ("unsubscribe", "opt out", "remove", "stop receiving", "manage preferences")
ATTACHMENT_WORDS = ("attach", "attached", "attachment", "file")
MARKETING_WORDS = ("free", "winner", "offer", "urgent", "discount")
SYSTEM_WORDS = ("system", "notification", "alert", "notice", "reminder")
PHISHING_WORDS = MARKETING_WORDS + ("click", "verify")
MISSPELT_WORDS = ("looo", "winnnn", "frree")
TRUE_LABELS = ("1", "spam", "true", "yes")
FALSE_LABELS = ("0", "ham", "false", "no")

# Published output labels with a stable English code for each.
ERROR_TYPES = {
    "fp_marketing": "营销类邮件被误判",
    "fp_system": "系统通知邮件被误判",
    "short_text": "短文本邮件误判",
    "fn_html": "HTML 伪装邮件漏判",
    "fn_phishing": "钓鱼邮件漏判",
    "fn_plain": "伪装正常邮件漏判",
    "fn_misspelt": "拼写变形邮件漏判",
    "correct": "正确",
}
RISK_LEVELS = {"safe": "安全", "suspicious": "可疑", "spam": "垃圾"}
