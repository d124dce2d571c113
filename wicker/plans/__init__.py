"""Tables of the price-basket model, from observations to the BI layer."""
