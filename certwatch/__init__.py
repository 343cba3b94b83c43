"""certwatch: TLS-certificate expiry and renewal analytics on Spark DataFrames."""

from certwatch.config import Params, SourceSpec

__all__ = ["Params", "SourceSpec"]
