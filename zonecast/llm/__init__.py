"""Training-data operators (chat layouts, fixity, decontamination, page
differencing, near and exact duplicates, URL filtering, quality, toxicity,
source mixing). Nothing else in the library imports this subpackage."""
