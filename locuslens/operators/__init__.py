"""DataFrame-to-DataFrame operators over sites, reads, coverage and manifests."""
