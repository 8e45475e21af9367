"""Envelope texts at the edges of the rules."""

_S = '"source":{"ts_ms":1000,"lsn":5}'
EDGES: list[str | None] = [
    None, "", "{not valid json", "[1,2,3]", '"text"', "5", "null", "{}", '{"op":"c"}', '{"source":{}}', '{"op":"c","source":null}',
    '{"op":null,"source":{}}', '{"op":"c","source":[]}', '{"op":"c","source":""}', '{"op":"c","source":0}', '{"op":"c","source":false}',
    '{"op":"c","source":[1]}', '{"op":"c","source":"x"}', '{"op":"c","source":5}', '{"op":"c","source":true}',
    '{"op":"c","source":{"ts_ms":null}}', '{"op":"c","source":{"ts_ms":0}}', '{"op":"c","source":{"ts_ms":1750000000000}}', '{"op":"c","source":{"ts_ms":1500.75}}',
    '{"op":"c","source":{"ts_ms":true}}', '{"op":"c","source":{"ts_ms":"1"}}', '{"op":"c","source":{"ts_ms":[1]}}', '{"op":"c","source":{"ts_ms":{}}}', '{"op":"c","source":{"ts_ms":999999999999999}}',
    '{"op":"c","source":{"lsn":"7"}}', '{"op":"c","source":{"lsn":7.5}}', '{"op":"c","source":{"lsn":true}}', '{"op":"c","source":{"lsn":29481192}}',
    '{"op":5,' + _S + "}", '{"op":true,' + _S + "}", '{"op":"zzz",' + _S + "}",
    '{"op":"c",' + _S + ',"transaction":{"id":"987"}}', '{"op":"c",' + _S + ',"transaction":{"id":5}}', '{"op":"c",' + _S + ',"transaction":null}', '{"op":"c",' + _S + ',"transaction":[]}', '{"op":"c",' + _S + ',"transaction":"x"}', '{"op":"c",' + _S + ',"transaction":{}}',
    '{"op":"c",' + _S + "} x", "{'op':'c'}", '{"op":"c",' + _S + ',"after":{"a":1.10}}', ' {"op":"c",' + _S + "} ", "{},{}",
]
