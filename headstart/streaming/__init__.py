"""headstart.streaming"""
