"""Documents and comparisons shared by the tests of the series part."""

import json


def document(coin="a", prices=(), caps=(), volumes=(), **other):
    data = {"prices": list(prices), "market_caps": list(caps), "total_volumes": list(volumes)}
    fields = {"coin_id": coin, "coin_name": coin.upper(), "coin_symbol": coin, "coin_image": "i", "market_cap_rank": 1}
    return json.dumps({**fields, "data": data, **other})


def bag(frame):
    return sorted(map(repr, (tuple(r) for r in frame.collect())))
