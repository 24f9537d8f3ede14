from flowvigil.functions.groups import captured_groups
from flowvigil.functions.hashing import ORIGIN, java_hash, origin_of, record_id
from flowvigil.functions.maps import json_object, lower_keys
from flowvigil.functions.once import once
from flowvigil.functions.times import epoch_now, parse_time
from flowvigil.functions.uris import clean_uri, uri_decode, uri_normalize, uri_tokens, uri_words

__all__ = [
    "ORIGIN",
    "captured_groups",
    "clean_uri",
    "epoch_now",
    "java_hash",
    "json_object",
    "lower_keys",
    "once",
    "origin_of",
    "parse_time",
    "record_id",
    "uri_decode",
    "uri_normalize",
    "uri_tokens",
    "uri_words",
]
