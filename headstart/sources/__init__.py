"""headstart.sources"""
