"""Lookup tables, code sets, patterns and formats that results depend on."""

# Units of USD per unit of currency (exact decimals, kept as text).
USD_PER_UNIT = {
    "AED": "0.2723",
    "USD": "1.0000",
    "EGP": "0.0206",
    "GBP": "1.2700",
    "EUR": "1.0800",
    "SAR": "0.2667",
    "KWD": "3.2500",
}

# The shorter rate list of the dashboard; any other currency takes the default.
DASHBOARD_USD_PER_UNIT = {
    "AED": "0.2723",
    "USD": "1.0",
    "EGP": "0.0206",
    "GBP": "1.27",
    "EUR": "1.08",
}
DASHBOARD_DEFAULT_RATE = "0.2723"

# Lower-case merchant spellings and the name they are reported under.
MERCHANT_SPELLINGS = {
    "meta platforms, inc.": "Meta",
    "meta platforms inc": "Meta",
    "facebook": "Meta",
    "google llc": "Google",
    "google ireland limited": "Google",
    "alphabet inc": "Google",
    "starbucks coffee": "Starbucks",
    "starbucks corporation": "Starbucks",
    "emirates airline": "Emirates",
    "emirates airlines": "Emirates",
    "b.tech": "B.Tech",
    "b tech": "B.Tech",
    "btech": "B.Tech",
    "amazon web services": "AWS",
    "amazon.com": "Amazon",
}

# Accepted codes.
CURRENCIES = ("AED", "USD", "EGP", "GBP", "EUR", "SAR", "KWD")
ENTRY_SIDES = ("DEBIT", "CREDIT")
CARD_STATUSES = ("ACTIVE", "TERMINATED")
HOME_CURRENCY = "AED"

# Accepted clearing timestamp patterns, tried in this order (day first).
CLEARING_TIME_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssZ",
    "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
)

# The five raw sources, which are also the first path component of an arriving file.
SOURCES = ("orgs", "users", "cards", "transactions", "clearing")

# User columns a restricted reader may see, and those nobody may see.
READABLE_USER_COLUMNS = (
    "id",
    "first_name",
    "last_name",
    "is_active",
    "is_verified",
    "track_id",
    "created_at",
    "updated_at",
    "deleted_at",
)
SECRET_USER_COLUMNS = ("email", "phone_number", "password")
