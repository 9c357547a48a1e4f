"""Fixed lookup tables of the sales channels."""

# fixed values: marketplace domain to region code
MARKETPLACE_REGION = {
    "Amazon.com": "US",
    "Amazon.co.uk": "UK",
    "Amazon.de": "DE",
    "Amazon.fr": "FR",
    "Amazon.it": "IT",
    "Amazon.es": "ES",
    "Amazon.com.au": "AU",
    "Amazon.ca": "CA",
    "Amazon.co.jp": "JP",
    "Amazon.in": "IN",
    "Amazon.nl": "NL",
    "Amazon.com.mx": "MX",
    "Amazon.com.br": "BR",
    "Amazon.se": "SE",
    "Amazon.pl": "PL",
}

# fixed values: marketplace domain to currency
MARKETPLACE_CURRENCY = {
    "Amazon.com": "USD",
    "Amazon.co.uk": "GBP",
    "Amazon.de": "EUR",
    "Amazon.fr": "EUR",
    "Amazon.it": "EUR",
    "Amazon.es": "EUR",
    "Amazon.com.au": "AUD",
    "Amazon.ca": "CAD",
    "Amazon.co.jp": "JPY",
    "Amazon.in": "INR",
    "Amazon.nl": "EUR",
    "Amazon.com.mx": "MXN",
    "Amazon.com.br": "BRL",
    "Amazon.se": "SEK",
    "Amazon.pl": "PLN",
}

# fixed values: region columns of the audio cross-tab
CROSSTAB_REGIONS = ("US", "UK", "DE", "FR", "AU", "CA", "JP", "IN", "ES")

# fixed values: currencies with a royalty column in the monthly summary
SUMMARY_CURRENCIES = ("USD", "GBP", "EUR", "JPY", "CAD", "INR", "PLN", "SEK", "BRL", "MXN", "AUD")

# fixed values: person-identifying columns
PERSONAL_COLUMNS = ("Author", "Author Name", "Primary Author", "Royalty Earner")
