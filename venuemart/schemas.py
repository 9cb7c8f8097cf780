"""Declared schemas of every source; nothing is inferred."""

from __future__ import annotations

REGISTER_CELLS = {
    "Name": "string",
    "TypeObject": "string",
    "OperatingCompany": "string",
    "Address": "string",
    "SeatsCount": "int",
    "SocialPrivileges": "string",
    "AdmArea": "string",
    "District": "string",
}

REGISTER_RAW = (
    "global_id long, Number int, Cells struct<global_id: long, Number: int, "
    + ", ".join(f"{name}: {kind}" for name, kind in REGISTER_CELLS.items())
    + ", PublicPhone: array<map<string,string>>, geoData: struct<coordinates: array<double>>>"
)

REGISTER = (
    "global_id long, Number int, "
    + ", ".join(f"{name} {kind}" for name, kind in REGISTER_CELLS.items())
    + ", PublicPhone array<string>, x_coord double, y_coord double"
)

_META = (
    "ok boolean, elapsed double, status_code int, reason string, url string, encoding string, "
    "headers map<string,string>, dttm string, sha256 string"
)
LISTING_DATA = "cards array<string>, next_link string"
DETAIL_DATA = (
    "x_coord double, y_coord double, avg_check string, opening_hours string, street_address string, "
    "address_locality string, aspect_stars map<string,int>, review string"
)


def _struct(ddl: str) -> str:
    return ", ".join(f"{field.split(' ', 1)[0]}: {field.split(' ', 1)[1]}" for field in ddl.split(", "))


LISTING_ENVELOPE = f"{_META}, data struct<{_struct(LISTING_DATA)}>"
DETAIL_ENVELOPE = f"{_META}, data struct<{_struct(DETAIL_DATA)}>"
ENVELOPE = _META

CARD = "title string, rating int, cuisine string, phone string, link string, city string, address string"
LISTING = f"{CARD}, url string, dttm string, fname string"
DETAILS = (
    "url string, dttm string, fname string, x_coord double, y_coord double, avg_check string, "
    "opening_hours string, street_address string, street_locality string, aspect_stars string, review string"
)
STAR_ASPECT = "global_id long, aspect_stars string, url string, rating int"
SENTENCE = "global_id long, review string, url string, source string, sentence_id long"
SCORES = "negative double, positive double, neutral double, skip double, speech double"
SENTENCE_SCORED = f"{SENTENCE}, {SCORES}, review_norm string, review_standard string"
MENTION = "global_id long, sentence_id long, aspect string, value string, count long"
MENTION_SCORED = f"{MENTION}, source string, url string, {SCORES}"
SENTIMENT_RAW = "review string, sentiment string"
SENTIMENT_TRAIN = "review string, sentiment int"
RATING = "global_id long, rating double"
