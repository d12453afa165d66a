"""Real-time commerce warehouse building blocks on PySpark.

Every operator is an ordinary function from DataFrames to DataFrames.  The same
function serves batch and Structured Streaming unless it needs keyed state; the
stateful ones have a batch form (`tidemart.operators.flags`) and a streaming form
(`tidemart.streaming.state`).
"""

__version__ = "0.1.0"
