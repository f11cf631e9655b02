"""The per-server warm-up state processor (T4), shipped to Python workers by value.

It imports only pandas and pyspark, and `stream_drop_warmup` registers
this module with cloudpickle by value, so workers run it without
`fleetpulse` being installed on them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class WarmupDrop(StatefulProcessor):
    """Per server, drop the first `n` windows that reach it (T4).

    Windows of one length close in start order as the watermark moves,
    so the first `n` windows a server emits are its `n` earliest: the
    batch rank rule (W1, W2), kept as one small counter per server.

    Rows come in frames of bounded size. While the counter is below `n`
    only the `n` earliest rows so far are held back and the rest goes on;
    once it is there, frames pass as they are.
    """

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("count", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        skip = max(0, self.n - (int(self.seen.get()[0]) if self.seen.exists() else 0))
        if not skip:
            yield from rows
            return
        held = None
        for pdf in rows:
            both = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            both = both.sort_values("wstart", kind="stable", ignore_index=True)
            held = both.iloc[:skip]
            if len(both) > skip:
                yield both.iloc[skip:]
        if held is not None:
            self.seen.update((self.n - skip + len(held),))

    def close(self) -> None:
        pass
