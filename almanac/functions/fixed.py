"""Fixed values of the catalog: word lists, codes and patterns that results depend on."""

# Letters that a slug transliterates, and what they become.
SLUG_FROM = "áäčďéěíĺľňóôŕřšťúýž"
SLUG_TO = "aacdeeillnoorrstuyz"

# Month names of the first extractor.
MONTHS_V1 = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "januar": 1, "februar": 2, "marec": 3, "maj": 5, "jun": 6, "juli": 7, "jul": 7, "oktober": 10,
    "januara": 1, "februara": 2, "marca": 3, "aprila": 4, "maja": 5, "juna": 6, "jula": 7, "augusta": 8, "septembra": 9, "oktobra": 10, "novembra": 11, "decembra": 12,
}

# Month names of the second extractor, which lacks one spelling.
MONTHS_V15 = {name: number for name, number in MONTHS_V1.items() if name != "juli"}

# Letters of a month name.
MONTH_LETTERS = "A-Za-záäčďéíĺľňóôŕšťúýžÁÄČĎÉÍĹĽŇÓÔŔŠŤÚÝŽ"

# Parts of host names of social networks.
SOCIAL_HOSTS = ["facebook.com", "instagram.com", "tiktok.com", "youtube.com", "youtu.be", "reddit.com", "t.me", "telegram.me", "twitter.com", "x.com", "linkedin.com"]

# Signs of a blocked page, for each extractor.
BLOCKED_BODY_V1 = ["cloudflare", "cf-challenge", "captcha", "access denied", "forbidden", "enable javascript", "cookie consent", "before you continue", "bot protection"]
BLOCKED_BODY_V15 = ["cloudflare", "cf-challenge", "captcha", "access denied", "forbidden", "verify you are human", "enable javascript", "bot protection"]
BLOCKED_CODES = [401, 403, 429, 503]

# Signs of a link to an event, and of one to something else.
LINK_HINTS = [
    "event", "events", "koncert", "concert", "podujatie", "podujatia", "program", "show", "gig", "live",
    "vstupenky", "tickets", "calendar", "kalendar", "agenda", "whatson", "line-up", "lineup",
]
LINK_VETOES = [
    "login", "register", "privacy", "cookie", "terms", "kontakt", "contact", "about", "kariera", "career",
    "newsletter", "faq", "support", "shop", "merch", "cart",
]

# Parts of class names of event containers.
CONTAINER_CLASSES = ["event", "concert", "gig", "show", "akcia", "podujatie", "listing", "card", "item", "entry", "program-item", "event-item", "event-card", "show-item"]

# Paths tried when a source lists no page that works.
FALLBACK_PATHS = [
    "/events", "/event", "/program", "/program/", "/podujatia", "/podujatia/", "/kalendar", "/kalendar/", "/calendar", "/calendar/",
    "/news", "/aktuality", "/culture", "/kultura",
]

# Fields and states that event rows must have.
EVENT_FIELDS = ["id", "title", "date", "venue_name", "venue_city", "categories", "source_urls", "status", "confidence"]
EVENT_STATES = ["upcoming", "past", "cancelled"]
CONFIDENCES = ["high", "medium", "low"]

WINDOW_DAYS = 90
CITY = "Bratislava"
