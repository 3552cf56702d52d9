"""Load runs and the registered queries."""
