"""delaykit: flight-delay analytics as Spark DataFrame / SQL / Structured Streaming jobs.

Every public function takes and returns a ``DataFrame`` (or a ``Column``) so the
work stays lazy, Catalyst-optimised and distributed over the executors.
"""

__version__ = "0.1.0"
