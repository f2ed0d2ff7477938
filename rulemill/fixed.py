"""Published formats of the rule languages and of the output.

Everything in this file is data that results depend on literally (separators,
option names, markers, white-space set). Behaviour lives elsewhere.
"""

# Rule types.
BLOCK = "block"
EXCEPTION = "exception"
HIDE = "hide"
HIDE_EXCEPTION = "hide-exception"
CSS_EXT = "css-ext"
SCRIPTLET = "scriptlet"
CSS_INJECT = "css-inject"
HTML = "html"
HTML_EXCEPTION = "html-exception"
HEADER = "header"
RULE_TYPES = [
    BLOCK, EXCEPTION, HIDE, HIDE_EXCEPTION, CSS_EXT, SCRIPTLET, CSS_INJECT,
    HTML, HTML_EXCEPTION, HEADER,
]

# Kinds of input lines.
KIND_BLANK = "blank"
KIND_HEADER = "header"
KIND_SECTION_MARKER = "section-marker"
KIND_COMMENT = "comment"
KIND_BLOCK_MARKER = "block-marker"
KIND_HASH_COMMENT = "hash-comment"
KIND_HOSTS = "hosts"
KIND_RULE = "rule"
RULE_KINDS = [KIND_HEADER, KIND_HOSTS, KIND_RULE]

# Header comments that are published.
HEADER_PREFIXES = ["! Title:", "! Expires:", "! Homepage:"]

# (separator, rule type) in the order in which a line is tested.
TYPE_SEPARATORS = [
    ("#@#", HIDE_EXCEPTION),
    ("#@?#", CSS_EXT),
    ("#?#", CSS_EXT),
    ("#@$$", HTML_EXCEPTION),
    ("$$", HTML),
    ("#@$?#", CSS_INJECT),
    ("#$?#", CSS_INJECT),
    ("#@$#", CSS_INJECT),
    ("#@%#", CSS_INJECT),
    ("#%#", None),      # decided by the body, see SCRIPT_BODY_PREFIXES
    ("#$#", None),
    ("##+js(", SCRIPTLET),
    ("##", HIDE),
]
SCRIPT_BODY_PREFIXES = ["script:", "//scriptlet", "script("]

# A line starting with "#" is an element rule only with one of these prefixes.
ELEMENT_PREFIXES = [
    "##", "#@#", "#@?#", "#?#", "#@$$", "#@$#", "#@%#", "#%#", "#$#",
    "#@$?#", "#$?#",
]

# Separators in the order in which the canonical key looks for a site list.
KEY_SEPARATORS = [
    "#@?#", "#@#", "#?#", "#@$$", "#@$#", "#@%#", "#@$?#", "#$?#", "#%#",
    "#$#", "##+js(", "$$", "##",
]

# Option names that make the text after "$" an option list.
KNOWN_OPTIONS = [
    "script", "image", "stylesheet", "object", "xmlhttprequest", "subdocument",
    "document", "other", "ping", "websocket", "webrtc", "media", "font", "popup",
    "important", "third-party", "match-case", "collapse", "all",
    "elemhide", "genericblock", "generichide", "specifichide",
    "inline-script", "inline-font", "strict1p", "3p", "1p", "doc", "frame",
    "empty", "mp4", "jsinject", "content", "network", "permissions",
    "domain", "csp", "redirect", "replace", "removeparam", "method", "header",
    "removeheader", "urlskip", "denyallow", "from", "to", "badfilter", "ext",
    "app", "strict-block", "uuid", "redirect-rule", "rewrite",
    "xhr", "stealth",
]

# Addresses that start a hosts row.
HOSTS_ADDRESSES = ["127.0.0.1", "0.0.0.0"]

# Section markers of a published edition.
MARK_EXCEPTION = "! ========== 例外规则（白名单） =========="
MARK_BLOCK = "! ========== 网络请求拦截 =========="
MARK_ELEMENT = "! ========== 元素隐藏规则 =========="
MARK_HIDE_EXCEPTION = "! ========== 隐藏例外 =========="
# Prefixes by which the markers are recognised again -> section.
MARK_PREFIXES = [
    ("! ========== 例外规则", "exception"),
    ("! ========== 网络请求拦截", "block"),
    ("! ========== 元素隐藏规则", "element"),
    ("! ========== 隐藏例外", "element"),
]
STAMP_PREFIX = "! Last modified:"

# Preamble of a published edition: texts, then counts, then the sources.
PREAMBLE = [
    "[AdBlock Plus 2.0]",
    "! Title: {title}",
    "! Description: {description}",
    "! Homepage: {homepage}",
    "! Expires: 20 minutes",
    "! Version: {stamp}",
    "! Last modified: {stamp}",
]
PREAMBLE_COUNTS = {
    "total_rules": "! Total rules: %d",
    "exception_rules": "!   Exception rules: %d",
    "block_rules": "!   Block rules: %d",
    "hide_rules": "!   Hide rules: %d",
}
PREAMBLE_SOURCES = "! Sources:"
PREAMBLE_SOURCE = "!   %s: %d rules (priority %d)"

# White space as Unicode text tools strip it (all of White_Space plus U+001C-1F).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regular-expression class body (Java syntax).
WS_CLASS = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Java regular expressions. Possessive quantifiers keep them linear and off the
# Java call stack, so a line may have any length.
PAT_LINES = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"
PAT_OPTION = (
    r"(?:\\,|\\|[^,/\\]++|/(?:\\(?:[\s\S]|\z)|[^\\/]++"
    r"|/(?!\p{L}*+(?:[,|$]|\z)))*+(?:/\p{L}*+)?+)++"
)
_LABEL = r"[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?"
PAT_ANCHORED_DOMAIN = rf"\|\|({_LABEL}(?:\.{_LABEL})*+)"
PAT_DOTTED_DOMAIN = rf"^({_LABEL}(?:\.{_LABEL})++)"
PAT_KEY_DOMAIN = rf"^\|*({_LABEL}(?:\.{_LABEL})++)"
PAT_HOSTS = rf"^(?:127\.0\.0\.1|0\.0\.0\.0)[{WS_CLASS}]+(.+)"
PAT_WWW = r"([^a-z0-9])www\."
PAT_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
PAT_OPTION_SEGMENT = r"[^,$]+|[,$]"
# Cheap tests before collapsing: two spaces or no plain ASCII text at all, then
# two spaces or white space other than the space.
PAT_MAYBE_SPACE = r"  |[^\x20-\x7e]"
PAT_ODD_SPACE = r"(?U)[\s\x1c-\x1f](?<! )|  "
PAT_MATCH_CASE = rf"(?:^|,)[{WS_CLASS}]*match-case[{WS_CLASS}]*(?:[=,]|\z)"
# Tokens joined by line feeds: one that is a known name or a key with a value.
PAT_VALID_TOKEN = (
    rf"(?:\A|\n)~*+(?:(?:{'|'.join(KNOWN_OPTIONS)})(?:\n|\z)"
    rf"|[{WS_CLASS}&&[^\n]]*+[^=\n{WS_CLASS}][^=\n]*+=)"
)
