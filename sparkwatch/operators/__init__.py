"""Detection, normalisation, quality and alert operators, DataFrame in and out."""
