"""DataFrame-in, DataFrame-out operators over plain (decrypted) columns."""
