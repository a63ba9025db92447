"""Word lists, patterns, labels and defaults that decide results.
All matching is by substring, so "outfit" holds "fit". Every operator takes its
list as a parameter; these are the defaults."""

from __future__ import annotations

# Cleaner
PROMOTIONAL = [
    "check out", "discover", "learn more", "sign up", "subscribe", "podcast", "newsletter",
    "article", "click here", "visit", "website", "blog", "download", "free", "trial",
    "today", "shop now", "buy", "purchase", "™", "®",
]
NAVIGATIONAL = ["menu", "navigation", "search", "home", "about", "contact", "page", "section"]
REQUIRED = [
    "wear", "dress", "match", "pair", "combine", "avoid", "choose", "fit", "style",
    "coordinate", "color", "pattern", "fabric", "material", "accessory", "accessories",
    "suit", "shirt", "pants", "shoes", "outfit", "formal", "casual", "business", "occasion",
]
CLEANER_ADVICE = ["should", "must", "avoid", "always", "never", "try", "consider", "recommended"]

# Validator
ADVICE = ["always", "never", "should", "must", "avoid", "best", "recommend", "ensure", "make sure"]
FASHION = ["suit", "jacket", "pants", "shirt", "shoes", "tie", "belt", "fit", "style", "wear", "dress", "color", "collar", "sleeve"]
PROHIBITED = [
    r"\$\d+", r"shop\s+", r"buy\s+", "click", "subscribe", r"question #\d+:", "how to",
    "i've", "i'm", "in this article", "article title", r"\?$", "what should you", "which style",
]

# Rule types: first list with a match decides
TYPES_A = [
    ("fit", ["fit", "size", "tight", "loose"]),
    ("color", ["color", "colour", "pattern", "print"]),
    ("formality", ["formal", "casual", "business", "dress code"]),
    ("accessories", ["accessory", "accessories", "jewelry", "watch"]),
    ("style", ["style", "trend", "fashion"]),
]
TYPES_B = [
    ("fit", ["fit", "sleeve", "hem", "cuff", "waist", "size", "length"]),
    ("color", ["color", "colour", "match", "contrast", "brown", "black"]),
    ("accessories", ["accessor", "belt", "tie", "watch", "shoe"]),
    ("formality", ["formal", "casual", "dress code"]),
    ("style", ["style", "trend", "fashion", "pair", "combine"]),
]

# Sentence extraction
KEYWORDS = [
    "wear", "dress", "outfit", "style", "fashion", "clothes", "shoes", "accessories",
    "fit", "color", "pattern", "formal", "casual", "match", "coordinate", "combination",
]
TEMPLATES = [
    "This is a clear fashion rule or guideline",
    "This describes how to wear clothing properly",
    "This explains fashion dos and don'ts",
]
LINE_ADVICE = ["should", "never", "always", "avoid", "must"]
FALLBACK_ADVICE = ["should", "never", "always", "avoid", "must", "match", "pair", "choose"]
FALLBACK_GARMENTS = ["suit", "jacket", "tie", "belt", "shoes", "shirt", "pants", "match", "fit", "lapel", "sleeve", "cuff"]
RULE_PROTOTYPE = "This is a concrete, actionable fashion rule about how to wear or combine clothing."
PROMO_PROTOTYPE = "This is promotional text, or navigational or call-to-action, not a specific rule."

# Pages
URL_KEYWORDS = ["guide", "rules", "how", "do", "dont", "tips", "tutorial", "etiquette", "fit", "style", "ways", "ways-to", "dos-and-donts"]
DROPPED_TAGS = ["script", "style", "nav", "footer", "aside", "header", "form", "iframe"]
MAIN_SELECTORS_A = ["article", 'div[class*="article"]', 'div[class*="post"]', 'div[class*="content"]', 'div[class*="main"]', ".article", ".post", ".post-content", ".entry-content", "main"]
MAIN_SELECTORS_B = ["article", ".article", ".post-content", ".entry-content", ".content", "main"]
PROMO_CLASSES = ["promo", "sidebar", "widget", "banner", "ad", "newsletter"]
LINE_TAGS = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li"]

# Spelling
SKIP_WORDS = [
    "reddit", "malefashionadvice", "femalefashionadvice", "streetwear", "uniqlo", "ootd", "h&m",
    "fitpic", "selvedge", "workwear", "athleisure", "menswear", "lookbook",
]

# Zero-shot labels
LABELS = ["rules", "advice", "dos and don'ts"]

# Digests
RULE_TYPES = ["absolute", "guideline", "trend", "contrarian"]
CATEGORIES = [
    "fit", "color", "formality", "fabric", "footwear", "accessories", "season", "pattern",
    "proportion", "grooming", "occasion", "general",
]
SEVERITIES = ["low", "medium", "high"]
PLATFORMS = ["reddit", "web", "forum", "blog"]
TOPICS = ["menswear", "general_style", "streetwear", "classic_menswear", "workwear", "formalwear", "athleisure", "other"]

# Messages of the cleaner and of the validator
TOO_SHORT = "Too short: %d words"
TOO_LONG = "Too long: %d words"
LOW_QUALITY = "Low quality score: %d"
IS_PROMOTIONAL = "Contains promotional content"
IS_NAVIGATIONAL = "Contains navigational content"
NO_KEYWORDS = "No fashion-related keywords found"
NO_ADVICE = "No advice indicators found"
ERROR_CAPITAL = "No capital start"
ERROR_PUNCTUATION = "No punctuation"
ERROR_QUESTION = "Contains question"
ERROR_SHORT = "Too short (%d words)"
ERROR_LONG = "Too long (%d words)"
ERROR_PROHIBITED = "Prohibited content"
ERROR_ADVICE = "No advice indicator"
ERROR_FASHION = "No fashion terms"
ERROR_CAPITALS = "Too many capitals (article title)"
ERROR_JSON = "Failed to parse JSON from response: "

# Prompts
FORUM_PROMPT = """<s>[INST] {system}

Analyze this Reddit fashion post and extract any fashion rules or advice:

{content}

Return only valid JSON. [/INST]"""
FORUM_TITLE = "Title: "
FORUM_POST = "Post Content: "
FORUM_COMMENT = "Top Comment: "
WEB_PROMPT = """<s>[INST] {system}

Analyze this text and extract any fashion rules or advice:

{content}

Return only valid JSON. [/INST]"""
DIGEST_PROMPT = """You are an expert menswear editor. Extract concrete, atomic style rules from this discussion.
Focus on durable rules (fit, proportion, color, formality), not product shilling.

Post:
- id: {post_id}
- title: {title}
- selftext: {selftext}

Top comments:
{comments}

For each rule, include at least one citation snippet (<=240 chars) with the comment_id or post_id.
"""
STRICT = "\n\nSTRICT: Your previous output did not validate. Reply with VALID JSON ONLY matching the schema. No explanations."
